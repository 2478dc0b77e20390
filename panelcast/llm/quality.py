"""Quality rules: cross-document line frequency (built-in functions only).

Lines are normalised and hashed, the distinct documents that hold a line are
counted per host, lines above the host's limit are removed, and a document
that loses too many of its words is rejected.  Exact copies of a text count
as one document.  So do near copies: texts of several lines that have few
words in lines of their own (lines that no other text of the host holds) are
together one holder of a line, so a clean text is not rejected for having
copies.

Defined results: a null or empty text has no words and fails the base rule;
a null host is a host of its own; repeated rows get the same verdict each;
an empty table gives an empty result; only the named columns are read, so
further columns of any name don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, bind, materialise, text_key, words

#: A line is boilerplate when more documents of its host hold it than both of these allow.
MIN_DOCS = 5
MAX_SHARE = 0.02
#: A document is depleted when over this percentage of its words stood in removed lines.
MAX_REMOVED_PCT = 50
#: A text of so many different lines at least, with under this percentage of their words in lines of its own, is a near copy.
NEAR_LINES = 4
OWN_PCT = 20
#: Up to so many boilerplate lines (16 bytes and a host name each) are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 200_000

REPEAT_WINDOW = 8


def _covered(hashes: Column, k: int) -> Column:
    """Positions covered by windows whose hash occurs twice or more."""
    def repeated(s: Column) -> Column:
        twin = lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])
        return F.array_sort(F.transform(F.filter(s, lambda x, i: F.coalesce(twin(x, i), F.lit(False))), lambda x: x["p"]))

    start = F.struct(F.lit(0).alias("n"), F.lit(-k).alias("last"))
    grow = lambda a, p: F.struct((a["n"] + F.least(F.lit(k), p - a["last"])).alias("n"), p.alias("last"))
    by_hash = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return bind(by_hash, lambda s: bind(repeated(s), lambda p: F.aggregate(p, start, grow)["n"]))


def repeat_words(word_list: Column, k: int = REPEAT_WINDOW) -> Column:
    """Words that lie in a ``k``-word window found twice or more in the text."""
    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - (k - 1)), lambda i: F.xxhash64(F.slice(h, i, k)))

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_covered(w, k))

    return bind(F.transform(word_list, lambda w: F.xxhash64(w)),
                lambda h: F.when(F.size(h) <= k, 0).otherwise(bind(windows(h), count)))


def base_rules(docs: DataFrame) -> DataFrame:
    """Base counts per document row, with host and text key for the verdict."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # "\n"-split lines with a word; a further line equal to an earlier one is a duplicate
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select(
        "doc_id", F.col("source").alias("host"), text_key(text).alias("key"),
        bind(words(text), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("repeated"))).alias("w"),
        F.length(F.regexp_replace(text, BLANK, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    n, rep = F.col("w")["n"].cast("long"), F.col("w")["repeated"].cast("long")
    return counted.select("doc_id", "host", "key", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                          rep.alias("n_repeat_words"), ((n < 20) | (100 * rep > 30 * n)).alias("base_failed"))


def document_lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: host, text key, hash of the normalised line, its words; words and number of the text's different lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tidy = F.transform(F.split(F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " "), "\n"), lambda x: F.trim(x))
    described = F.transform(F.filter(tidy, lambda x: x != ""), lambda x: F.struct(
        F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n")))
    whole = bind(described, lambda d: bind(F.array_distinct(d), lambda u: F.struct(
        d.alias("d"), F.aggregate(u, F.lit(0), lambda a, x: a + x["n"]).alias("words"), F.size(u).alias("lines"))))
    texts = docs.select(F.col("source").alias("host"), text_key(text).alias("key"), whole.alias("x"))
    return (texts.select("host", "key", "x.words", "x.lines", F.explode("x.d").alias("l"))
            .select("host", "key", F.col("l")["line"].alias("line"), F.col("l")["n"].alias("n"), "words", "lines"))


def line_counts(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Candidates (host, line), lines of more than ``min_docs`` texts; and per text (host, key) the words ``own`` of lines it holds alone."""
    # distinct (host, line, text) first: a hot line is spread by the texts that hold it
    held = (lines.select("host", "line", "key", "n").distinct().groupBy("host", "line")
            .agg(F.count("*").alias("n_docs"), F.min(F.struct("key", "n")).alias("one")))
    alone, many = F.col("n_docs") == 1, F.col("n_docs") > min_docs
    return (held.where(alone | many)
            .groupBy("host", F.when(alone, F.col("one")["key"]).alias("key"), F.when(many, F.col("line")).alias("line"))
            .agg(F.sum(F.col("one")["n"]).alias("own")))


def _match(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join on columns of which any may be null."""
    renamed = right.select(*[F.col(c).alias(f"{c}_") if c in on else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    return left.join(F.broadcast(renamed) if right.count() <= BROADCAST_ROWS else renamed, same, how).drop(*[f"{c}_" for c in on])


def text_lines(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, key, line, n, words, lines): words of every text in each candidate line, and (line null) in all others."""
    candidates = counts.where(F.col("line").isNotNull()).select("host", "line", F.lit(True).alias("many"))
    marked = _match(document_lines(docs), candidates, ["host", "line"])
    return marked.groupBy("host", "key", F.when(F.col("many"), F.col("line")).alias("line")).agg(
        F.sum("n").alias("n"), F.max("words").alias("words"), F.max("lines").alias("lines"))


def frequent_lines(docs: DataFrame, per_text: DataFrame, counts: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(host, line, n_docs) of lines held by more distinct documents than the host's limit; near copies are one holder together."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = counts.where(F.col("key").isNotNull()).select("host", "key", "own")
    holders = per_text.where(F.col("line").isNotNull())
    renamed = own.select(F.col("host").alias("host_"), F.col("key").alias("key_"), "own")
    holders = holders.join(renamed, F.col("host").eqNullSafe(F.col("host_")) & (F.col("key") == F.col("key_")), "left")
    near = (F.col("lines") >= NEAR_LINES) & (100 * F.coalesce("own", F.lit(0)) < OWN_PCT * F.col("words"))
    held = (holders.groupBy("host", "line").agg((F.count_if(~near) + F.max(near.cast("int"))).alias("n_docs"))
            .where(F.col("n_docs") > min_docs))
    hosts = (docs.select(F.col("source").alias("host_"), text_key(text).alias("key")).distinct()
             .groupBy("host_").agg(F.count("*").alias("host_docs")))
    return (held.join(hosts, F.col("host").eqNullSafe(F.col("host_")))
            .where(F.col("n_docs") > max_share * F.col("host_docs")).select("host", "line", "n_docs"))


def depleted(docs: DataFrame, max_removed_pct: int = MAX_REMOVED_PCT, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(host, key) of texts that lose over ``max_removed_pct`` percent of their words with the removed lines."""
    counts = materialise(line_counts(document_lines(docs), min_docs))
    per_text = materialise(text_lines(docs, counts))
    frequent = materialise(frequent_lines(docs, per_text, counts, min_docs, max_share)).select("host", "line", F.lit(True).alias("gone"))
    # sums over all copies of a text: the share is that of one copy
    return (_match(per_text, frequent, ["host", "line"]).groupBy("host", "key")
            .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("gone"), F.col("n")).otherwise(0)).alias("removed"))
            .where(100 * F.col("removed") > max_removed_pct * F.col("n")).select("host", "key"))


def _same_text(bad: DataFrame) -> tuple[DataFrame, Column]:
    renamed = bad.select(F.col("host").alias("host_"), F.col("key").alias("key_"), F.lit(True).alias("_bad"))
    return renamed, F.col("host").eqNullSafe(F.col("host_")) & (F.col("key") == F.col("key_"))


def quality_report(docs: DataFrame, **limits) -> DataFrame:
    """Base counts and the verdict for every document row."""
    bad, same = _same_text(depleted(docs, **limits))
    return base_rules(docs).join(bad, same, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("_bad").isNull()).alias("kept"))


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    report = base_rules(docs)
    bad, same = _same_text(depleted(docs, **limits))
    failed = report.where("base_failed").select("host", "key").unionByName(bad.select(F.col("host_").alias("host"), F.col("key_").alias("key")))
    failed = failed.distinct().select(F.col("host").alias("__failed_host"), F.col("key").alias("__failed_key"))
    keyed = F.coalesce(F.col("text"), F.lit(""))
    return docs.join(failed, F.col("source").eqNullSafe(F.col("__failed_host")) & (text_key(keyed) == F.col("__failed_key")), "left_anti")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
words AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
pos AS (SELECT rid, w, unnest(range(1, len(w) - {REPEAT_WINDOW} + 2)) AS p FROM words),
wins AS (SELECT rid, p, array_to_string(w[p:p + {REPEAT_WINDOW - 1}], ' ') AS win FROM pos),
twice AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, win) AS c FROM wins) WHERE c > 1),
covered AS (SELECT rid, sum(least({REPEAT_WINDOW}, p - coalesce(before, -{REPEAT_WINDOW}))) AS n
  FROM (SELECT rid, p, lag(p) OVER (PARTITION BY rid ORDER BY p) AS before FROM twice) GROUP BY rid),
raw AS (SELECT rid, unnest(string_split(text, chr(10))) AS x FROM d),
dup AS (SELECT rid, count(*) - count(DISTINCT x) AS n FROM raw WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
base AS (SELECT rid, doc_id, host, text, len(w) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d JOIN words USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN covered USING (rid)),
lines AS (SELECT rid, host, text, trim(regexp_replace(x, '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ') AS line
  FROM (SELECT rid, host, text, unnest(string_split(lower(text), chr(10))) AS x FROM d)),
sized AS (SELECT *, length(line) - length(replace(line, ' ', '')) + 1 AS n FROM lines WHERE line <> ''),
hosts AS (SELECT host, count(DISTINCT text) AS host_docs FROM d GROUP BY host),
holding AS (SELECT DISTINCT host, text, line, n FROM sized),
shared AS (SELECT *, count(*) OVER (PARTITION BY host, line) AS c FROM holding),
texts AS (SELECT host, text, count(*) >= {NEAR_LINES} AND 100 * sum(CASE WHEN c = 1 THEN n ELSE 0 END) < {OWN_PCT} * sum(n) AS near
  FROM shared GROUP BY host, text),
counted AS (SELECT s.host, s.line, count(*) FILTER (NOT near) + max(near::INT) AS n_docs
  FROM holding s JOIN texts t ON s.host IS NOT DISTINCT FROM t.host AND s.text = t.text GROUP BY s.host, s.line),
frequent AS (SELECT c.host, c.line FROM counted c JOIN hosts h ON c.host IS NOT DISTINCT FROM h.host
  WHERE n_docs > {MIN_DOCS} AND n_docs > {MAX_SHARE} * h.host_docs),
lost AS (SELECT s.rid FROM sized s LEFT JOIN frequent f ON s.host IS NOT DISTINCT FROM f.host AND s.line = f.line
  GROUP BY s.rid HAVING 100 * sum(CASE WHEN f.line IS NULL THEN 0 ELSE s.n END) > {MAX_REMOVED_PCT} * sum(s.n))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND base.rid NOT IN (SELECT rid FROM lost) AS kept
FROM base
"""
