"""Benchmark decontamination by template windows, in DataFrame functions only.

Canonical template of a text: numbers, units that follow a number, and names
(a capitalised word after a space, so not one that begins a sentence or line)
become typed placeholders; the rest is lower-cased words without their punctuation.  Windows of ``window``
template tokens of the benchmark (an item with fewer: the whole item) are
hash-joined with those of the documents.  Matches of one document and one item
at one distance are an alignment.  An alignment counts if its windows are equal
as text too, if its slots are consistent (one value of the item always stands
for one value of the document, as in a re-parameterised question), and if it
has enough windows: a run's worth of ``min_tokens`` tokens, or
``min_share`` of the item's windows where that is less.

Every window is looked up under further keys that know no types, so that a verbatim copy
is found whatever its case, what stands before it, and how many slots it has:

* ``plain``: the same windows of lower-cased tokens with their values, under the same rule.
  Windows of the template with fewer than half literal tokens are left out there (rows of
  numbers would match anything), but not here, where the values count.
* ``whole``: an item under ``min_item`` tokens is too short for windows; all its words
  and punctuation marks (``min_whole`` of them at least) have to stand together.

What a hit of these keys finds is verbatim by itself and has no slots to test.  The benchmark
index, and then the table of alignments, is broadcast up to ``broadcast_windows`` windows;
beyond that both sides are shuffled.  Documents are read once for all keys and sizes.

Not found: a re-parameterised copy in which one item value stands for two document values,
unless enough of it is verbatim; a re-parameterised copy whose names are in other case.

Edge cases: a null or empty text has no windows; items under ``min_whole`` words and marks
never match; of a very long text all windows are taken, and its row holds its tokens and
two numbers a token; rows are told apart by doc_id and text, so repeated rows give one
result and share their fate (ties between alignments go to the largest counts), and
documents with a null doc_id are compared like any other; empty tables give an
empty result; other columns are ignored by ``contaminated`` and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.llm.common import fresh, materialize
from storecast.llm.quality import let

# Private-use characters that mark a token's type, and units.
NUMBER, NAME, UNIT, POINT = "\ue000", "\ue001", "\ue002", "\ue003"
UNITS = ("%|°c|°f|km/h|mph|kg|mg|g|km|cm|mm|m|ml|l|lbs?|oz|ft|feet|inch(?:es)?|miles?|met(?:er|re)s?|grams?|kilos?|"
         "lit(?:er|re)s?|gallons?|seconds?|minutes?|hours?|days?|weeks?|months?|years?|dollars?|euros?|cents?|percent|"
         "heures?|jours?|semaines?|mois|ans?|stunden?|tage?|wochen?|jahre?|horas?|d[ií]as?|semanas?|a[nñ]os?")


def marked(text: Column) -> Column:
    """Lower-case text in which every slot token begins with the mark of its type."""
    for mark in (NUMBER, NAME, UNIT, POINT):
        text = F.replace(text, F.lit(mark), F.lit(" "))
    named = F.lower(F.regexp_replace(text, r"\p{Lu}(?<=[^\s.!?:] .)(?=\p{Ll})", f"{NAME}$0"))
    joined = F.regexp_replace(named, r"(?<=[0-9])[.,:/](?=[0-9])", POINT)
    numbered = F.regexp_replace(joined, rf"(?<![\p{{L}}\p{{N}}{NAME}{POINT}])[0-9]+(?:{POINT}[0-9]+)*", f"{NUMBER}$0")
    united = F.regexp_replace(numbered, rf"({NUMBER}[0-9{POINT}]+)[\x20-]?({UNITS})(?![\p{{L}}\p{{N}}%])", f"$1 {UNIT}$2")
    return F.when(F.rlike(text, F.lit("[0-9]")), united).otherwise(named)


def template(text: Column) -> Column:
    """Marked text with every slot token cut down to its mark."""
    return F.regexp_replace(text, rf"([{NUMBER}-{UNIT}])[\p{{L}}\p{{N}}{POINT}]+", "$1")


def spaced(text: Column) -> Column:
    """The tokens of marked text with one space between them."""
    # only letters, digits and the like are cut off a slot, so marked text and template split alike
    return F.trim(F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}{NUMBER}-{POINT}]+", " "))


def tokens(joined: Column) -> Column:
    return F.array_remove(F.split(joined, " "), "")


def window_hashes(words: Column, window: int) -> Column:
    """The hash of each window of ``window`` tokens, in order."""
    def of(w: Column) -> Column:
        hashes = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, window)]))
        return F.slice(hashes, 1, F.size(w) - (window - 1))

    return let(words, lambda w: F.when(F.size(w) >= window, of(w)).otherwise(F.array().cast("array<bigint>")))


def _text(df: DataFrame) -> Column:
    return F.coalesce(df["text"].cast("string"), F.lit(""))


TEMPLATE_KEY, PLAIN_KEY, WHOLE_KEY = "template", "plain", "whole"


def spelled(text: Column) -> Column:
    """Lower-case words and single punctuation marks, in order."""
    for mark in (NUMBER, NAME, UNIT, POINT):
        text = F.replace(text, F.lit(mark), F.lit(" "))
    spaced = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", " $0 "), r"[\s\p{Z}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def views(text: Column, m: Column, kinds) -> list[Column]:
    """For every key in ``kinds`` a struct of its name, marked tokens (``raw``) and tokens
    (``words``); ``m`` is the spaced marked text."""
    plain = tokens(F.translate(m, NUMBER + NAME + UNIT, ""))
    made = {TEMPLATE_KEY: lambda: (tokens(m), tokens(template(m))), PLAIN_KEY: lambda: (plain, plain),
            WHOLE_KEY: lambda: (spelled(text),) * 2}
    out = []
    for kind in kinds:
        raw, words = made[kind]()
        out.append(F.struct(F.lit(kind).alias("kind"), raw.alias("raw"), words.alias("words")))
    return out


def index(benchmark: DataFrame, window: int = 8, min_item: int = 5, min_whole: int = 3) -> DataFrame:
    """A row for each window of the benchmark: key, item, its number of windows under the key,
    place, size, hash, tokens and marked tokens."""
    every = (TEMPLATE_KEY, PLAIN_KEY, WHOLE_KEY)
    one = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _text(benchmark).alias("t")) \
        .select("item_id", "t", spaced(marked(F.col("t"))).alias("m"))
    long_ = F.size(F.filter("v", lambda x: (x["kind"] == PLAIN_KEY) & (F.size(x["words"]) >= min_item))) > 0
    one = one.select("item_id", F.array(*views(F.col("t"), F.col("m"), every)).alias("v")) \
        .select("item_id", long_.alias("long"), F.inline("v"))
    whole = F.col("kind") == WHOLE_KEY
    one = one.where((whole & ~F.col("long") & (F.size("words") >= min_whole))
                    | (~whole & (F.size("words") >= min_item) & (F.size("raw") == F.size("words")))) \
        .withColumn("size", F.when(whole, F.size("words")).otherwise(F.least(F.size("words"), F.lit(window))))
    places = F.sequence(F.lit(0), F.size("words") - F.col("size"))
    rows = one.select("kind", "item_id", "size", "raw", "words", F.explode(places).alias("place")).select(
        "kind", "item_id", "size", "place", F.slice("words", F.col("place") + 1, F.col("size")).alias("words"),
        F.slice("raw", F.col("place") + 1, F.col("size")).alias("raw"))
    literal = F.size(F.filter("words", lambda w: ~F.rlike(w, F.lit(f"^[{NUMBER}-{UNIT}]"))))
    rows = materialize(rows.where(2 * literal >= F.col("size")), "decontam-windows")
    # the hash must be that of window_hashes: all tokens of the window as arguments
    sizes = sorted(r["size"] for r in rows.select("size").distinct().collect())     # lengths of windows and short items
    if not sizes:
        return rows.withColumn("hash", F.lit(0).cast("long")).withColumn("n_windows", F.lit(0).cast("long"))
    by_size = [rows.where(F.col("size") == n).withColumn(
        "hash", F.xxhash64(*[F.get("words", F.lit(k)) for k in range(n)])) for n in sizes]
    out = by_size[0]
    for more in by_size[1:]:
        out = out.unionByName(more)
    counts = out.groupBy(F.col("item_id").alias("of"), F.col("kind").alias("by")).agg(F.count("*").alias("n_windows"))
    return out.join(counts, out.item_id.eqNullSafe(counts.of) & (out.kind == counts.by)).drop("of", "by")


SALT = 0x9E3779B97F4B


def _salt(looked: list[tuple[str, int]]) -> Column:
    """The number that tells the hashes of a key and size from those of others."""
    out = F.lit(0).cast("long")
    for i, (kind, size) in enumerate(looked):
        out = F.when((F.col("kind") == kind) & (F.col("size") == size), F.lit(SALT * (i + 1))).otherwise(out)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 8, min_tokens: int = 13, min_share: float = 0.8,
                 min_item: int = 5, broadcast_windows: int = 1_000_000, min_whole: int = 3) -> DataFrame:
    """doc_id, row_hash (of the text), item_id, n_matched, n_windows and verbatim for
    every document and benchmark item that it holds."""
    items = materialize(index(benchmark, window, min_item, min_whole), "decontam-index")
    looked = sorted(tuple(r) for r in items.select("kind", "size").distinct().collect())  # a few keys and sizes
    if not looked:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, row_hash long, item_id long, n_matched long, n_windows long, verbatim boolean")
    kinds = sorted({k for k, _ in looked})
    # one number a window, so that the join's table is keyed by numbers; texts are compared below
    keys = items.select("kind", F.col("hash").bitwiseXOR(_salt(looked)).alias("key"), "size", "item_id", "place", "n_windows")
    if items.count() <= broadcast_windows:
        keys = F.broadcast(keys)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text(docs).alias("text"))
    rows = rows.withColumn("row_hash", F.xxhash64("text"))
    seen = rows.withColumn("m", spaced(marked(F.col("text")))).select(
        "doc_id", "row_hash", *[v.alias(k) for k, v in zip(kinds, views(F.col("text"), F.col("m"), kinds), strict=True)])
    at = seen.select("doc_id", "row_hash", F.inline(F.array(*[F.struct(
        F.lit(SALT * (i + 1)).alias("salt"), window_hashes(F.col(f"{k}.words"), n).alias("hashes"))
        for i, (k, n) in enumerate(looked)]))).select("doc_id", "row_hash", "salt", F.posexplode("hashes").alias("pos", "hash"))
    found = at.select("doc_id", "row_hash", "pos", F.col("hash").bitwiseXOR(F.col("salt")).alias("key")).join(keys, "key")
    need = F.least(F.lit(min_tokens - window + 1), F.ceil(F.col("n_windows") * min_share))
    aligned = materialize(
        found.withColumn("shift", F.col("pos") - F.col("place")).groupBy("doc_id", "row_hash", "kind", "item_id", "shift")
        .agg(F.collect_set(F.struct("place", "size")).alias("places"), F.max("n_windows").alias("n_windows"))
        .where(F.size("places") >= need), "decontam-aligned")

    # the tokens of the documents that have an alignment, broadcast under the same bound
    by_row = aligned.groupBy("doc_id", "row_hash").agg(
        F.collect_list(F.struct("kind", "item_id", "shift", "places", "n_windows")).alias("found"))
    n_places = aligned.agg(F.sum(F.size("places"))).first()[0] or 0
    by_row = F.broadcast(by_row) if n_places <= broadcast_windows else by_row.hint("merge")
    texts = rows.alias("r").join(
        by_row.alias("b"), F.col("r.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("r.row_hash") == F.col("b.row_hash"))) \
        .select("r.doc_id", "r.row_hash", "found", "text").dropDuplicates(["doc_id", "row_hash"])
    own = texts.withColumn("m", spaced(marked(F.col("text")))).select(
        "doc_id", "row_hash", "found", F.inline(F.array(*views(F.col("text"), F.col("m"), kinds))))
    per = own.select("doc_id", "row_hash", "kind", "raw", "words", F.explode(F.filter(
        "found", lambda f: f["kind"] == F.col("kind"))).alias("f")).select(
        "doc_id", "row_hash", "kind", "f.item_id", "f.shift", "f.n_windows", F.transform("f.places", lambda p: F.struct(
            p["place"].alias("place"), p["size"].alias("size"),
            F.slice("raw", F.col("f.shift") + p["place"] + 1, p["size"]).alias("own_raw"),
            F.slice("words", F.col("f.shift") + p["place"] + 1, p["size"]).alias("own_words"))).alias("w"))
    single = per.select("doc_id", "row_hash", "kind", "item_id", "shift", "n_windows", F.inline("w"))
    texts_of = items.select(F.col("kind").alias("k"), F.col("item_id").alias("i"), F.col("place").alias("p"), "raw", "words")
    same = single.join(texts_of, F.col("item_id").eqNullSafe(F.col("i")) & (F.col("place") == F.col("p"))
                       & (F.col("kind") == F.col("k"))).where("words = own_words")
    pairs = F.filter(F.zip_with("raw", "own_raw", lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                     lambda x: F.rlike(x["a"], F.lit(f"^[{NUMBER}-{UNIT}]")))
    judged = same.groupBy("doc_id", "row_hash", "kind", "item_id", "shift").agg(
        F.count_distinct("place").alias("n_matched"), F.max("n_windows").alias("n_windows"),
        F.array_distinct(F.flatten(F.collect_list(pairs))).alias("pairs"))
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda x: x["a"])))
    return judged.where(consistent & (F.col("n_matched") >= need)).groupBy("doc_id", "row_hash", "item_id").agg(
        F.max("n_matched").alias("n_matched"), F.max("n_windows").alias("n_windows"),
        F.bool_or(F.forall("pairs", lambda x: x["a"] == x["b"])).alias("verbatim"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a benchmark item, with all their columns."""
    key, bad_id, bad_hash = fresh(docs, "_row_hash", "_bad_id", "_bad_hash")
    bad = contaminated(docs, benchmark, **options).select(
        F.col("doc_id").alias(bad_id), F.col("row_hash").alias(bad_hash)).distinct()
    keyed = docs.withColumn(key, F.xxhash64(_text(docs)))
    bad = materialize(bad, "decontam-bad")  # its size is known then: broadcast only while small
    return keyed.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col(bad_id))
                      & (F.col(key) == F.col(bad_hash)), "left_anti").drop(key)


def _sql_marked(text: str) -> str:
    """``marked`` without look-around: what stands beside a match is matched and
    put back, twice where matches can share it."""
    def sub(x: str, pattern: str, to: str) -> str:
        return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"

    x = text
    for mark in (NUMBER, NAME, UNIT, POINT):
        x = f"replace({x}, '{mark}', ' ')"
    for _ in range(2):
        x = sub(x, r"([^\s.!?:] )(\p{Lu}\p{Ll})", rf"\1{NAME}\2")
    x = f"lower({x})"
    for _ in range(2):
        x = sub(x, "([0-9])[.,:/]([0-9])", rf"\1{POINT}\2")
    x = sub(x, rf"(^|[^\p{{L}}\p{{N}}{NAME}{POINT}])([0-9]+(?:{POINT}[0-9]+)*)", rf"\1{NUMBER}\2")
    return sub(x, rf"({NUMBER}[0-9{POINT}]+)[ -]?({UNITS})([^\p{{L}}\p{{N}}%]|$)", rf"\1 {UNIT}\2\3")


def _sql_tokens(x: str) -> str:
    spaced = f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}{NUMBER}-{POINT}]+', ' ', 'g')"
    return f"list_filter(string_split({spaced}, ' '), lambda t: t <> '')"


_TEMPLATE = rf"regexp_replace(m, '([{NUMBER}-{UNIT}])[\p{{L}}\p{{N}}{POINT}]+', '\1', 'g')"
_PLAIN = f"regexp_replace(m, '[{NUMBER}-{UNIT}]', '', 'g')"
_SPELLED = (rf"list_filter(regexp_split_to_array(regexp_replace(lower(regexp_replace(text, '[{NUMBER}-{POINT}]', ' ', 'g')), "
            rf"'([^\p{{L}}\p{{N}}])', ' \1 ', 'g'), '[\s\p{{Z}}\x0b]+'), lambda t: t <> '')")
_SLOT = f"^[{NUMBER}-{UNIT}]"


def _sql_views(source: str, key: str) -> str:
    """Tokens of every text under every key: ``key``, kind, raw, words."""
    marked_text = f"(select {key}, text, {_sql_marked('text')} as m from {source})"
    return (f"select {key}, 'template' as kind, {_sql_tokens('m')} as raw, {_sql_tokens(_TEMPLATE)} as words from {marked_text}\n"
            f"  union all select {key}, 'plain', {_sql_tokens(_PLAIN)}, {_sql_tokens(_PLAIN)} from {marked_text}\n"
            f"  union all select {key}, 'whole', {_SPELLED}, {_SPELLED} from {source}")


#: ``contaminated`` with its defaults in DuckDB SQL over ``documents`` and ``benchmark``; windows are compared as text.
SQL = f"""
with dt as materialized (
  select row_number() over () as d, doc_id, text from (select distinct doc_id, coalesce(text, '') as text from documents)),
d as materialized ({_sql_views('dt', 'd')}),
bt as (select row_number() over () as b, item_id, coalesce(text, '') as text from benchmark),
bv as ({_sql_views('bt', 'b, item_id')}),
b as (
  select item_id, kind, raw, words, case when kind = 'whole' then len(words) else least(len(words), 8) end as size
  from (select *, bool_or(kind = 'plain' and len(words) >= 5) over (partition by b) as long from bv)
  where case when kind = 'whole' then not long and len(words) >= 3 else len(words) >= 5 end),
bw as (
  select item_id, kind, size, place, raw, array_to_string(words[place + 1:place + size], ' ') as win
  from (select *, unnest(range(0, len(words) - size + 1)) as place from b)
  where 2 * len(list_filter(words[place + 1:place + size], lambda t: not regexp_matches(t, '{_SLOT}'))) >= size),
bn as (select item_id, kind, count(*) as n_windows from bw group by item_id, kind),
dw as (
  select d, kind, pos, size, array_to_string(words[pos + 1:pos + size], ' ') as win
  from (select d, kind, words, size, unnest(range(0, len(words) - size + 1)) as pos
        from d join (select distinct kind, size from bw) z using (kind) where len(words) >= size)),
hit as (
  select dw.d, bw.kind, bw.item_id, dw.pos - bw.place as shift, bw.place, bw.size, dw.pos, bw.raw
  from dw join bw on dw.win = bw.win and dw.size = bw.size and dw.kind = bw.kind),
slot as (
  select hit.d, hit.kind, item_id, shift, hit.raw[place + k + 1] as a, d.raw[pos + k + 1] as b
  from (select *, unnest(range(0, size)) as k from hit where kind = 'template') hit join d on hit.d = d.d and hit.kind = d.kind
  where regexp_matches(hit.raw[place + k + 1], '{_SLOT}')),
kept as (
  select d, kind, item_id, shift, count(distinct (a, b)) = count(distinct a) as consistent, bool_and(a = b) as same
  from slot group by all),
al as (select d, kind, item_id, shift, count(distinct place) as n_matched from hit group by all)
select doc_id, al.item_id, max(n_matched)::bigint as n_matched, max(n_windows)::bigint as n_windows,
       bool_or(coalesce(same, true)) as verbatim
from al join bn on al.item_id is not distinct from bn.item_id and al.kind = bn.kind
     left join kept on kept.d = al.d and kept.item_id is not distinct from al.item_id and kept.shift = al.shift and kept.kind = al.kind
     join dt on dt.d = al.d
where coalesce(consistent, true) and n_matched >= least(6, ceil(n_windows * 0.8))
group by dt.d, doc_id, al.item_id
"""
