from collections import defaultdict

import regex
from pyspark.sql import functions as F

from llm.oracle import duck_rows, rows
from storecast.llm import decontam, queries
from storecast.llm.common import table

SF = "/root/testdata/sf0.01"
BENCH = "item_id long, text string, hash string, size string, words string"


def tokenise(text):
    """(template, value) of every token, in plain code."""
    n, p, u, d = decontam.NUMBER, decontam.NAME, decontam.UNIT, decontam.POINT
    t = regex.sub(rf"[{n}-{d}]", " ", text or "")
    t = regex.sub(r"(?<=[^\s.!?:] )(?=\p{Lu}\p{Ll})", p, t).lower()
    t = regex.sub(r"(?<=[0-9])[.,:/](?=[0-9])", d, t)
    t = regex.sub(rf"(?<![\p{{L}}\p{{N}}{p}{d}])([0-9]+(?:{d}[0-9]+)*)", rf"{n}\1", t)
    t = regex.sub(rf"({n}[0-9{d}]+)[ -]?({decontam.UNITS})(?![\p{{L}}\p{{N}}%])", rf"\1 {u}\2", t)
    raw = regex.findall(rf"[\p{{L}}\p{{N}}{n}-{d}]+", t)
    return [(regex.sub(rf"([{n}-{u}])[\p{{L}}\p{{N}}{d}]+", r"\1", x), x) for x in raw]


def is_slot(x):
    return x[0] in decontam.NUMBER + decontam.NAME + decontam.UNIT


def views(text):
    """The three readings of a text: typed template, plain tokens, words and marks."""
    typed = tokenise(text)
    plain = [v.translate({ord(c): None for c in decontam.NUMBER + decontam.NAME + decontam.UNIT}) for _, v in typed]
    bare = regex.sub(rf"[{decontam.NUMBER}-{decontam.POINT}]", " ", text or "").lower()
    spelled = regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s\p{Z}]", bare)
    return {"template": typed, "plain": [(w, w) for w in plain], "whole": [(w, w) for w in spelled]}


def brute(docs, bench, window=8, min_tokens=13, share=0.8, min_item=5, min_whole=3):
    index, n_windows, items = defaultdict(list), defaultdict(int), {}
    for i, text in bench:
        seen = views(text)
        for kind, toks in seen.items():
            if kind == "whole":
                if len(seen["plain"]) >= min_item or len(toks) < min_whole:
                    continue
            elif len(toks) < min_item:
                continue
            items[kind, i], size = toks, len(toks) if kind == "whole" else min(window, len(toks))
            for p in range(len(toks) - size + 1):
                w = tuple(t for t, _ in toks[p:p + size])
                if 2 * sum(not is_slot(t) for t in w) >= size:
                    index[kind, w].append((i, p))
                    n_windows[kind, i] += 1
    sizes = {(kind, len(w)) for kind, w in index}
    out = {}
    for d, text in docs:
        seen, found = views(text), defaultdict(list)
        for kind, size in sizes:
            toks = seen[kind]
            for q in range(len(toks) - size + 1):
                for i, p in index.get((kind, tuple(t for t, _ in toks[q:q + size])), ()):
                    found[kind, i, q - p].append((p, size))
        for (kind, i, shift), places in found.items():
            toks = seen[kind]
            pairs = {(items[kind, i][p + k][1], toks[p + shift + k][1]) for p, size in places for k in range(size)
                     if is_slot(items[kind, i][p + k][0])}
            need = min(min_tokens - window + 1, -(-n_windows[kind, i] * 4 // 5))
            if len(places) >= need and len({a for a, _ in pairs}) == len(pairs):
                old = out.get((d, i), (0, 0, False))
                out[d, i] = (max(old[0], len(places)), max(old[1], n_windows[kind, i]), old[2] or all(a == b for a, b in pairs))
    return {(d, i, *v) for (d, i), v in out.items()}


def result(df):
    return {tuple(r) for r in df.select("doc_id", "item_id", "n_matched", "n_windows", "verbatim").collect()}


def test_whole_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    got = result(queries.QUERIES["op8_decontamination"](spark, SF))
    assert got == brute(docs, bench) and len(got) > 10


Q = ("If Alice buys 12 apples for 3.50 dollars and then Alice gives Bob 5 apples, how many apples does Alice still have "
     "after walking 7 km to the old market?")
FILLER = "some words that go before it and "


def bench_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x") for i, t in rows], BENCH)


def test_reparameterised_question_is_caught(spark, docs_of, edge_rows):
    other = Q.replace("Alice", "Zoé").replace("Bob", "Kim").replace("12", "904").replace("3.50", "8").replace("5 ", "66 ")
    mixed = Q.replace("then Alice", "then Carol").replace("gives Bob", "gives Alice")
    half = " ".join(Q.split()[:9])
    docs = edge_rows + [(30, FILLER + Q), (31, FILLER + other + " and more"), (32, FILLER + mixed), (33, half),
                        (34, Q.upper()), (40, FILLER + Q.replace(" ", "%%% ").replace("?", "?###")), (35, "12 13 14 15 16 17 18 19 20 21 22 23 24 25"), (36, other + " " + Q),
                        (30, FILLER + Q), (37, "the tiny one is here too"), (38, "we saw the tiny one is here, too. Yes")]
    bench = [(1, Q), (2, None), (3, ""), (4, "too short here"), (5, "1 2 3 4 5 6 7 8 9 10 11 12 13"),
             (6, "the tiny one is here too"), (None, "an item without any number that is still an item for us")]
    docs.append((39, "an item without any number that is still an item for us"))
    df, b = docs_of(docs), bench_of(spark, bench)
    got = result(decontam.contaminated(df, b))
    assert got == brute(docs, bench)
    # 32 holds a long enough verbatim run beside its inconsistent names, 34 is the item in capitals
    assert {d for d, i, *_ in got} >= {30, 31, 32, 34, 36, 37, 38, 39, 40} and not {d for d, *_ in got} & {33, 35}
    assert (31, False) in {(d, v) for d, _, _, _, v in got} and (30, True) in {(d, v) for d, _, _, _, v in got}
    assert result(decontam.contaminated(df, b, broadcast_windows=0)) == got
    small = docs_of([d for d in docs if len(d[1] or "") < 10_000])
    plain = rows(decontam.contaminated(small, b).drop("row_hash"))
    assert plain == duck_rows(decontam.SQL, documents=small, benchmark=b)
    kept = decontam.clean(df, b)
    assert kept.columns == df.columns
    bad = {d for d, *_ in got}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in bad)


KINDS = {
    "arithmetic": "Compute 12 + 45 * 7 - 3 / 9 and give 2 digits",
    "choice": "Who wrote War And Peace: Leo Tolstoy, Fyodor Dostoevsky, Anton Chekhov Or Ivan Turgenev?",
    "short": "What is 12 + 7?",
    "question": "Which planet in our solar system has the most moons?",
    "rows": "3 1 4 1 5 9 2 6 5 3 5 8 9 7 9 3",
    "long": "At 5 o clock the baker had 5 fish and " + " ".join(f"word{i}" for i in range(40)) + " so he sold 5 fish",
    "names": Q}


def test_verbatim_items_of_every_kind_in_any_case_and_context(spark, docs_of):
    bench = list(enumerate(KINDS.values()))
    docs, want = [], set()
    for i, text in bench:
        for c, copy in enumerate((text, text.upper(), text.lower())):
            for b, before in enumerate(("", "Quiz. ", "He then asked us ", "quiz%%% ", "(", "and\n")):
                docs.append((100 * i + 10 * c + b, before + copy + (" and so on" if b % 2 else "")))
                want.add((100 * i + 10 * c + b, i))
    # near the items, but not them
    clean = ["12 + 8 is not what is asked", "what is 12 - 7", "3 1 4 1 5 9 2 7 1 8 2 8 1 8 2 8", "the planet has the most moons in our story",
             "War And Peace is by Leo Tolstoy and others", "compute the digits and give them", "What is it? 12 + 7 of them"]
    docs += [(9000 + i, t) for i, t in enumerate(clean)]
    docs.append((8000, KINDS["long"][:-6] + "6 fish"))         # one number changed at the end of a long item
    df, b = docs_of(docs), bench_of(spark, bench)
    got = decontam.contaminated(df, b)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want | {(8000, 5)}
    assert result(got) == brute(docs, bench)
    assert rows(got.drop("row_hash")) == duck_rows(decontam.SQL, documents=df, benchmark=b)
    assert decontam.clean(df, b).count() == len(clean)


def test_empty(spark, docs_of):
    docs, bench = docs_of([(1, Q)]), bench_of(spark, [(1, Q)])
    none, no_bench = docs.where(F.lit(False)), bench.where(F.lit(False))
    assert decontam.contaminated(none, bench).count() == decontam.contaminated(docs, no_bench).count() == 0
    assert decontam.clean(docs, no_bench).count() == 1 and decontam.clean(none, bench).count() == 0
