"""Quality rules at document and host level, in DataFrame functions only.

Document rules: ``short`` (under ``min_words`` words), ``repeats`` (over 20 % of
the words in 5-word windows that the text has twice or more), ``symbols`` (over
``max_symbol_pct`` symbols of ``#*$%&|<>`` for 100 word characters) and
``dup_lines`` (over ``max_dup_line_pct`` % of the lines equal an earlier one).
The first two fail a document at once (``base_failed``).

Host rules: the failures of each rule are added up by host; a host's rate is
shrunk towards the rate of all documents with a beta prior whose strength comes
from the spread of the hosts' rates (method of moments, weighted by documents).
The prior also says what a bad rate is: ``spread`` of its standard deviations
over its mean, but not under ``least_bad``, for a host most of whose documents
pass is not condemned by the rest, nor over ``most_bad``, so that a few bad hosts
that widen the prior (or are most of the rows) do not excuse themselves.  A host is rejected if, by the normal
approximation of its beta posterior, its rate is over the bad rate for any rule
with probability ``Phi(sure)`` (0.975); so are its documents: what happened
to pass there is not trusted either.

Edge cases: a null or empty text has no words and fails ``short``; documents of
a null host get no host verdict; repeated rows count as documents of their own;
a lower bound that equals the bad rate does not reject; a text is one value of a
task, its words, lines and windows arrays of it, whole at any length; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.llm.common import SPACES, materialize

RULES = ("short", "repeats", "symbols", "dup_lines")
SALTS = 16
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for the row, also where
    ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for a null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def repeat_words(words: Column, window: int = 5) -> Column:
    """How many words lie in windows that occur twice or more (the first included)."""
    def covered(hashes: Column) -> Column:
        return let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), from_sorted)

    def from_sorted(s: Column) -> Column:
        again = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: (
            F.coalesce(F.get(s, k - 1)["h"] == F.get(s, k)["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == F.get(s, k)["h"], F.lit(False))))
        return let(F.array_sort(F.transform(again, lambda k: F.get(s, k)["i"])), union_length)

    def union_length(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - p, F.lit(window))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def of_windows(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")) \
            .otherwise(covered(hashes))

    def windows(w: Column) -> Column:
        hashes = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, window)]))
        return F.slice(hashes, 1, F.size(w) - (window - 1))

    return F.when(F.size(words) <= window, F.lit(0).cast("bigint")).otherwise(
        let(words, lambda w: let(windows(w), of_windows)))


def document_metrics(docs: DataFrame, host: str = "source", min_words: int = 10, max_symbol_pct: int = 30,
                     max_dup_line_pct: int = 30) -> DataFrame:
    """doc_id, host, the counts of every whole text and a boolean for each rule."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
                       F.col("text").cast("string").alias("text")) \
        .select("doc_id", "host", words_of(F.col("text")).alias("words"), lines.alias("lines"),
                (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    counts = base.select(
        "doc_id", "host", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"))
    return counts.select(
        "*", (F.col("n_words") < min_words).alias("short"),
        (100 * F.col("n_repeat_words") > 20 * F.col("n_words")).alias("repeats"),
        (100 * F.col("n_symbols") > max_symbol_pct * F.col("word_chars")).alias("symbols"),
        (100 * F.col("n_dup_lines") > max_dup_line_pct * F.col("n_lines")).alias("dup_lines"))


def host_verdicts(metrics: DataFrame, least_bad: float = 0.5, most_bad: float = 0.8, spread: float = 3.0,
                  sure: float = 1.96) -> DataFrame:
    """host, documents, and for every rule the shrunken rate, the rate that the host's
    exceeds with probability Phi(sure), and the bad rate; and whether it is rejected."""
    hosts = metrics.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n"), *[F.count_if(F.col(r)).alias(r) for r in RULES])
    pooled = hosts.agg(F.sum("n").alias("n_all"), F.count("*").alias("n_hosts"),
                       *[F.sum(r).alias(f"{r}_all") for r in RULES],
                       # sum of n * (k / n) ** 2, for the spread of the rates
                       *[F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_sq") for r in RULES])
    for r in RULES:
        mean = F.col(f"{r}_all") / F.col("n_all")
        noise = mean * (1 - mean) * F.col("n_hosts") / F.col("n_all")
        between = F.col(f"{r}_sq") / F.col("n_all") - mean * mean - noise
        pooled = pooled.withColumn(f"{r}_mean", mean).withColumn(f"{r}_strength", F.greatest(F.lit(1.0), F.least(
            F.lit(1e6), F.when(between > 1e-9, mean * (1 - mean) / between - 1).otherwise(1e6))))
    columns = []
    for r in RULES:
        mean, strength = F.col(f"{r}_mean"), F.col(f"{r}_strength")
        rate = (F.col(r) + mean * strength) / (F.col("n") + strength)
        columns += [rate.alias(f"{r}_rate"),
                    (rate - sure * F.sqrt(rate * (1 - rate) / (F.col("n") + strength + 1))).alias(f"{r}_low"),
                    F.greatest(F.lit(least_bad), F.least(
                        F.lit(most_bad), mean + spread * F.sqrt(mean * (1 - mean) / (strength + 1)))).alias(f"{r}_bad")]
    rates = hosts.crossJoin(F.broadcast(pooled)).select("host", "n", *columns)  # one row
    over = [F.col(f"{r}_low") > F.col(f"{r}_bad") for r in RULES]
    return rates.withColumn("rejected", over[0] | over[1] | over[2] | over[3])


def judge(docs: DataFrame, host: str = "source", least_bad: float = 0.5, most_bad: float = 0.8, spread: float = 3.0,
          sure: float = 1.96, **limits) -> DataFrame:
    """Metrics, base_failed, host_rejected and kept for every row of ``docs``."""
    metrics = materialize(document_metrics(docs, host, **limits), "quality")
    # written, so that the planner knows its size: broadcast while small, else
    # shuffled with a salt, for a host may hold a third of all documents
    verdicts = host_verdicts(metrics, least_bad, most_bad, spread, sure)
    hosts = materialize(verdicts.where("rejected").select("host", "rejected"), "quality-hosts")
    hosts = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    failed = F.col("short") | F.col("repeats")
    return metrics.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")) \
        .join(hosts, ["host", "salt"], "left").drop("salt") \
        .withColumn("base_failed", failed).withColumn("host_rejected", F.coalesce("rejected", F.lit(False))) \
        .withColumn("kept", ~failed & ~F.col("host_rejected")).drop("rejected")


#: The same in DuckDB SQL over ``documents``; windows are compared as text.
SQL = r"""
with d as (
  select row_number() over () as r, doc_id, source as host, coalesce(text, '') as text from documents),
w as (
  select r, doc_id, host, text,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
         list_filter(string_split(text, chr(10)), lambda x: not regexp_full_match(x, '[\x20\x09-\x0D]*')) as lines
  from d),
win as (
  select r, i, array_to_string(words[i:i + 4], ' ') as win
  from (select r, words, unnest(range(1, len(words) - 3)) as i from w where len(words) >= 5)),
again as (
  select r, i from (select r, i, count(*) over (partition by r, win) as c from win) where c >= 2),
rep as (
  select r, sum(least(5, coalesce(nxt - i, 5)))::bigint as n_repeat_words
  from (select r, i, lead(i) over (partition by r order by i) as nxt from again) group by r),
m as (
  select w.r, doc_id, host, len(words)::bigint as n_words,
         len(array_to_string(words, ''))::bigint as word_chars,
         (len(text) - len(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::bigint as n_symbols,
         len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from w left join rep on w.r = rep.r),
f as (
  select *, (n_words < 10)::int as short, (100 * n_repeat_words > 20 * n_words)::int as repeats,
         (100 * n_symbols > 30 * word_chars)::int as symbols, (100 * n_dup_lines > 30 * n_lines)::int as dup_lines
  from m),
fails as (
  select host, rule, count(*)::double as n, sum(fail)::double as k
  from (unpivot f on short, repeats, symbols, dup_lines into name rule value fail)
  where host is not null group by host, rule),
pooled as (
  select rule, sum(k) / sum(n) as mean,
         sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2
           - sum(k) / sum(n) * (1 - sum(k) / sum(n)) * count(*) / sum(n) as spread
  from fails group by rule),
prior as (
  select rule, mean, greatest(1.0, least(1e6,
           case when spread > 1e-9 then mean * (1 - mean) / spread - 1 else 1e6 end)) as strength from pooled),
posterior as (
  select host, (k + mean * strength) / (n + strength) as rate, n + strength + 1 as weight,
         greatest(0.5, least(0.8, mean + 3.0 * sqrt(mean * (1 - mean) / (strength + 1)))) as bad_rate
  from fails join prior using (rule)),
bad as (
  select distinct host from posterior where rate - 1.96 * sqrt(rate * (1 - rate) / weight) > bad_rate)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (short + repeats > 0) as base_failed, (short + repeats = 0 and bad.host is null) as kept
from f left join bad on f.host = bad.host
"""
