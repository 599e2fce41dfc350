"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base spans (email, ip, card, phone; see ``base_spans``) always stay.  Besides
them a text has looser candidates: emails written with "(at)" or as "joe at example
dot com" with a known top-level domain (parts of at most 64 and 63 characters, up to six labels after the first, as
in mail), IPv6 addresses in full or compressed, card numbers with dots, phone numbers
without a plus.  Over base spans and
candidates three labelers vote yes, no or nothing:

* regex: the strict shape, or letters or digits that touch the candidate;
* gazetteer: known top-level domains, card issuers, number prefixes;
* context: cue words within ``REACH`` characters, for and against.

Counts of (kind, votes, features) over all documents are a table of bounded size
(at most 4 x 27 x 128 rows); on it expectation-maximisation estimates how
reliable each labeler is for each kind, and a logistic span classifier is
trained on its posteriors.  A candidate is added if the classifier gives it at
least ``threshold``.

Offsets are code points of the whole text, ends exclusive.  Edge cases: a null or
empty text has no spans; a very long text is read as a whole, in time that grows
with its length times the logarithm of its spans; of candidates that overlap, the kind
listed first has it, then the leftmost (ties); repeated rows have the same spans each;
an empty table gives an empty result and a model that adds nothing; other columns
pass through, one named like a result is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.llm.common import add_columns, logistic, slices

KINDS = ("email", "ip", "card", "phone")
REACH = 40

# The characters and shapes of the base rules.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never begins inside a run of digits: its first digit would have begun an earlier one
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser shapes.
AT_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[{] ?(?:at|AT|arobase|arroba) ?[)\]}] ?[A-Za-z0-9-]{1,63}"
                      r"(?:(?:\.| ?[(\[{] ?(?:dot|DOT|punkt|point|punto) ?[)\]}] ?)[A-Za-z0-9-]{1,63}){1,6}")
SAID_EMAIL = re.compile(r"\b[A-Za-z0-9][A-Za-z0-9._+-]{0,63} (?:at|AT|arobase|arroba) [A-Za-z0-9-]{1,63}"
                        r"(?: (?:dot|DOT|punkt|point|punto) [A-Za-z0-9-]{1,63}){1,6}")
SPOKEN = " (?:dot|DOT|punkt|point|punto) |:[0-9A-Fa-f]{0,4}:"
IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,8}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
DOT_CARD = re.compile(r"(?<![0-9.])[0-9]{4}(?:\.[0-9]{4}){3}(?![0-9.])")
BARE_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{2,5}\)[\x20-]?|[0-9]{2,5}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")

# Gazetteers (generic top-level domains; of two letters, English words that
# follow a "dot" in prose, and those that are no country's) and cue words (English, French, German, Spanish).
GENERIC_DOMAINS = frozenset("""aero agency app arpa asia bank biz blog cat cloud club com coop dev edu email gov info
    int jobs live ltd mail media mil mobi museum name net news online org post pro shop site space store tech tel top
    travel web wiki work world xyz""".split())
AFTER_A_DOT = frozenset("am as at be by do id in is it me my no so to us".split())
NO_COUNTRY = frozenset("ab an da di du el en go he if of on or ou oh ok ot un up we wo xx ya zu".split())
CUES = {
    "email": r"e-?mail|mail|contact|kontakt|courriel|correo|write|schreib|[eé]crire",
    "ip": r"\bip\b|address|adresse|direcci|server|serveur|servidor|host|client|login",
    "card": r"card|karte|carte|tarjeta|visa|master|amex|credit|kredit|cr[eé]dit",
    "phone": r"tel|phone|fon|fax|call|mobil|m[oó]vil|llam|appel|anruf|handy|portable",
}
CUES = {k: re.compile(v, re.IGNORECASE) for k, v in CUES.items()}
AGAINST = re.compile(r"version|release|order|invoice|isbn|issn|page|section|token|sha|md5|hash|code|rechnung|bestell|"
                     r"commande|facture|pedido|factura|\bv\.?$", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def emails(t: str) -> Iterator[tuple[int, int]]:
    """Matches of the base email rule: the local part of an @ is the run of its
    characters before it, so every @ is looked at once."""
    end, at, before = 0, t.find("@"), 0
    while at >= 0:
        low = max(end, before)
        start = low + len(t[low:at].rstrip(LOCAL))
        if start < at and (m := DOMAIN.match(t, at + 1)):
            yield start, m.end()
            end = m.end()
        before, at = at + 1, t.find("@", max(at + 1, end))


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), leftmost and without overlap in each kind."""
    out = [(0, s, e) for s, e in emails(t)]
    for m in IP.finditer(t):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(t):
        d = digits_of(m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in PHONE.finditer(t):
        if 9 <= len(digits_of(m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def is_ip6(s: str) -> bool:
    """Eight groups, or fewer with one ``::`` and a digit or letter somewhere."""
    groups, gaps = s.split(":"), s.count("::")
    if ":::" in s or gaps > 1 or not s.strip(":"):
        return False
    if s[0] == ":" and s[:2] != "::" or s[-1] == ":" and s[-2:] != "::":
        return False
    return len([g for g in groups if g]) <= 7 if gaps else len(groups) == 8


def listed_domain(label: str) -> bool:
    """A generic top-level domain, or two letters as countries have."""
    d = label.lower()
    return d in GENERIC_DOMAINS or len(d) == 2 and d.isascii() and d.isalpha() and d not in NO_COUNTRY


def is_said(s: str) -> bool:
    """The last word is a top-level domain, and no English word after "dot"."""
    dot, label = s.split(" ")[-2:]
    return listed_domain(label) and not (dot.lower() == "dot" and label.lower() in AFTER_A_DOT)


def _union(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover, in order and apart."""
    starts, ends = [], []
    for s, e in sorted(spans):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def loose_spans(t: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that touch no base span, nor one of a rule before."""
    out: list[tuple[int, int, int]] = []
    taken = [(s, e) for _, s, e in base]
    for kind, rule in ((0, AT_EMAIL), (0, SAID_EMAIL), (1, IP6), (2, DOT_CARD), (3, BARE_PHONE)):
        starts, ends = _union(taken)
        for m in rule.finditer(t):
            s, e = m.span()
            if rule is SAID_EMAIL and not is_said(m[0]) or kind == 1 and not is_ip6(m[0]) \
                    or kind == 2 and not luhn(digits_of(m[0])) or kind == 3 and not 7 <= len(digits_of(m[0])) <= 15:
                continue
            k = bisect_right(ends, s)  # the first stretch that ends after s
            if k == len(ends) or starts[k] >= e:
                out.append((kind, s, e))
                taken.append((s, e))
    return out


def evidence(t: str, kind: int, s: int, e: int, strict: bool) -> tuple[int, int]:
    """The labelers' votes (three digits in base 3: 0 nothing, 1 no, 2 yes) and the feature bits."""
    span, d = t[s:e], digits_of(t[s:e])
    before, after = t[max(0, s - REACH):s], t[e:e + REACH]
    touched = bool(before[-1:].isalnum()) or bool(after[:1].isalnum())
    if kind == 0:
        listed = listed_domain(re.split(r"[^A-Za-z0-9-]+", span.rstrip(")]} "))[-1])
    elif kind == 1:
        listed = re.match(r"10\.|127\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.|"
                          r"(?i:fe80|f[cd][0-9a-f]{2}|[23][0-9a-f]{3}):|::1$", span) is not None
    elif kind == 2:
        listed = re.match(r"4|5[1-5]|2[2-7]|3[47]|6011|65", d) is not None
    else:
        listed = re.match(r"\+(?:1|33|34|49|44|39|43|41)|\(?0", span) is not None
    near = before + " " + after
    cue, against = CUES[KINDS[kind]].search(near) is not None, AGAINST.search(before) is not None
    regex = 2 if strict else 1 if touched else 0
    context = 0 if cue == against else 2 if cue else 1
    bits = (touched, listed, cue, against, bool(re.search(r"[ ()\[\]-]", span)), len(d) >= 10, e - s >= 12)
    return 9 * regex + 3 * (2 if listed else 0) + context, sum(b << i for i, b in enumerate(bits))


N_FEATURES = 7


def candidates(texts: pa.Array) -> list[list[tuple[int, int, int, bool, int, int]]]:
    """For each text: (kind, start, end, base, votes, features).  Texts without
    a digit, @, bracket, spoken dot or two colons are told apart on the bytes."""
    out: list[list] = [[] for _ in range(len(texts))]
    if not len(texts):
        return out
    texts = pa.concat_arrays([texts])  # offsets from 0
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1 + texts.offset)[texts.offset:]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    hit = np.flatnonzero(np.isin(raw[offsets[0]:offsets[-1]], np.frombuffer(b"0123456789@([{", np.uint8), kind="table"))
    marked = np.searchsorted(offsets, hit + offsets[0], side="right") - 1
    spoken = np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, SPOKEN), False).to_numpy(zero_copy_only=False))
    for i in np.union1d(marked, spoken).tolist():
        t = texts[i].as_py()
        if not t:
            continue
        base = base_spans(t)
        for strict, spans in ((True, base), (False, loose_spans(t, base))):
            out[i] += [(k, s, e, strict, *evidence(t, k, s, e, strict)) for k, s, e in spans]
    return out


@dataclass
class Model:
    """reliability[kind][labeler][y][vote] (vote 0, nothing, is 1), weights[kind] (last: bias)."""
    reliability: np.ndarray
    prior: np.ndarray
    weights: np.ndarray
    threshold: float

    def accepts(self, kind: int, features: int) -> bool:
        x = np.array([*(features >> i & 1 for i in range(N_FEATURES)), 1.0])
        return bool(1 / (1 + np.exp(-x @ self.weights[kind])) >= self.threshold)


def fit(counts: list[tuple[int, int, int, int]], rounds: int = 50, threshold: float = 0.8) -> Model:
    """A model from rows (kind, votes, features, count)."""
    k = len(KINDS)
    rel, prior, weights = np.ones((k, 3, 2, 3)), np.full(k, 0.5), np.zeros((k, N_FEATURES + 1))
    weights[:, -1] = -10
    for kind in range(k):
        rows = sorted(r[1:] for r in counts if r[0] == kind)
        if not rows:
            continue
        votes = np.array([[v // 9, v // 3 % 3, v % 3] for v, _, _ in rows])
        n = np.array([r[2] for r in rows], float)
        p = np.clip(0.5 + 0.2 * ((votes == 2).sum(1) - (votes == 1).sum(1)), 0.05, 0.95)
        for _ in range(rounds):
            prior[kind] = (1 + (n * p).sum()) / (2 + n.sum())
            for j in range(3):
                for v in (1, 2):  # a labeler that says nothing tells nothing
                    on = votes[:, j] == v
                    # a labeler is taken to be right rather than wrong before it is seen
                    rel[kind, j, 1, v] = (n * p)[on].sum() + (2 if v == 2 else 1)
                    rel[kind, j, 0, v] = (n * (1 - p))[on].sum() + (2 if v == 1 else 1)
            rel[kind, :, :, 0] = 1
            rel[kind, :, :, 1:] /= rel[kind, :, :, 1:].sum(-1, keepdims=True)
            like = [np.log(y) + sum(np.log(rel[kind, j, i, votes[:, j]]) for j in range(3))
                    for i, y in ((0, 1 - prior[kind]), (1, prior[kind]))]
            p = 1 / (1 + np.exp(np.clip(like[0] - like[1], -30, 30)))
        x = np.array([[*(f >> i & 1 for i in range(N_FEATURES)), 1] for _, f, _ in rows], float)
        weights[kind] = logistic(x, p, n)
    return Model(rel, prior, weights, threshold)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").cast(pa.string())
        for i, j in slices(texts):
            found = [(k, v, f) for row in candidates(texts.slice(i, j - i)) for k, _, _, _, v, f in row]
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], pa.int32()) for c in range(3)],
                                             ["kind", "votes", "features"])


def learn(docs: DataFrame, threshold: float = 0.8) -> Model:
    """The model of all documents; what reaches the driver is the bounded table of patterns."""
    rows = docs.select(F.col("text").cast("string").alias("text")) \
        .mapInArrow(_patterns, "kind int, votes int, features int").groupBy("kind", "votes", "features").count().collect()
    return fit([tuple(r) for r in rows], threshold=threshold)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def annotate(docs: DataFrame, model: Model, names: tuple[str, str] = ("base_spans", "pii_spans")) -> DataFrame:
    """``docs`` with the base spans and all spans of every text, by kind and start."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    add = np.array([[model.accepts(k, f) for f in range(1 << N_FEATURES)] for k in range(len(KINDS))])

    def find(texts: pa.Array) -> list[pa.Array]:
        found = [sorted(row) for row in candidates(texts)]
        return [pa.array([[{"kind": KINDS[k], "start": s, "end": e} for k, s, e, strict, _, f in row
                           if strict or all_spans and add[k, f]] for row in found], kind) for all_spans in (False, True)]

    return add_columns(docs, f"{names[0]} {SPANS}, {names[1]} {SPANS}", find)


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets,
    e.g. ``[EMAIL]``; of spans that overlap the first is named.  A null text stays null."""
    def mask(text: str | None, row: list) -> str | None:
        out, end = [], 0
        for s, e, k in sorted((s, e, k) for k, s, e, strict, _, f in row if strict or add[k, f]):
            if s >= end:
                out += [text[end:s], f"[{KINDS[k].upper()}]"]
            end = max(end, e)
        return text if not end else "".join(out) + text[end:]

    add = np.array([[model.accepts(k, f) for f in range(1 << N_FEATURES)] for k in range(len(KINDS))])
    name = "_redacted"
    while name in docs.columns:
        name += "_"
    new = add_columns(docs, f"{name} string", lambda texts: [
        pa.array([mask(t, r) for t, r in zip(texts.to_pylist(), candidates(texts), strict=True)], pa.string())])
    return new.select([F.col(name).alias("text") if c == "text" else F.col(c) for c in docs.columns])


def digest(annotated: DataFrame) -> DataFrame:
    """The counts and strings of the contract from annotated documents."""
    def line(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(k) for k in KINDS]
    return annotated.select("doc_id", *counts, F.sha2(line("base_spans"), 256).alias("base_sha256"),
                            line("pii_spans").alias("spans"))
