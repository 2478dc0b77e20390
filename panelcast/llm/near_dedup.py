"""MinHash near-dedup by a multi-index Hamming join.

A document's set holds its distinct five-word shingles (64-bit hashes).
Documents of equal sets form a class.  A class's signature has SYMBOLS
16-bit minima.  Two signatures that differ in at most ``distance(percent)``
symbols differ, by the pigeonhole principle, in at most ``ERRORS`` symbols of
one of the chunks; so for every chunk each way to leave out one symbol is a
key, and such signatures share a key.  A pair of the similarity asked for
exceeds that distance with a probability of MISSED at most (24 symbols and 13
chunks for 0.85, 28 and 15 for 0.8); every other pair is found.

Classes that share a key are compared by their signatures and joined into
families, and within a family links are confirmed on the full sets.  Only the
links of a spanning forest are written, so a family of n has fewer than n of
them, however many pairs are similar.

A key or family of over TILE members is dealt into tiles, and each pair of
tiles is a group of its own: no group has over 2 * TILE members, and no
partner is left out.  A member is sent to every tile, so from LARGE tiles on
the group first goes through rounds with pivots, each a pass over what is
left of it: members near the pivot are linked with it and
leave.  Both distances are metrics, so a member that stays can only be linked
with one that left if it lies within twice the distance of that pivot; such
pairs (the pivot's near ones by its shell) are compared afterwards, by
signatures simply taken into the family.  A family of copies of one text thus
costs rows in proportion to its members.  What is left after the rounds is
dealt into tiles.

Defined results: documents without words have an empty set and are their own
component; a null id comes after all others and gets a null component of its
own; in the report all rows with the id of their component are kept;
``drop_near_duplicates`` decides by row, one of each component stays whether
ids are null, repeated or neither; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_key
from .components import components
from .repeats import runs
from .sequences import LOWER, NO_ID, Block, Words, gram_hashes, mix, powers

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
SYMBOLS, ERRORS = 64, 1
#: The probability at most that a pair just as similar as asked for has no key in common.
MISSED = 5e-6
TILE = 1024
#: Groups of more tiles than this go through rounds; up to it, sending members to all tiles costs less than the passes.
LARGE = 16
#: Passes over the rest of a large group, each with a pivot of its own; salts that spread such a group's rows over tasks.
ROUNDS, SALTS = 4, 64
#: Ids (8 bytes each) that are broadcast at most to pick out documents.
BROADCAST_IDS = 500_000
BATCH_BYTES = 1 << 20

FACTORS = (mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))


def distance(percent: int) -> int:
    """The least distance that a pair of this similarity exceeds with a probability of MISSED at most."""
    differ, more = 1 - percent / 100, 0.0
    for d in range(SYMBOLS, 0, -1):
        more += comb(SYMBOLS, d) * differ ** d * (1 - differ) ** (SYMBOLS - d)
        if more > MISSED:
            return d
    return 0


DISTANCE = distance(PERCENT)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts): the distinct shingle hashes of each text, ascending, one text after the other."""
    block = Block(np.zeros(len(texts), np.int64), np.array([len(x) for x in texts], np.int64), b"".join(texts))
    words = Words(block, lower=True)
    count = np.diff(words.starts)
    h = gram_hashes(words.hash, SHINGLE)
    doc = np.repeat(np.arange(len(texts)), count)[:len(h)]
    at = np.arange(len(h))
    whole = at + SHINGLE <= words.starts[1:][doc] if len(h) else np.zeros(0, bool)
    h, doc = h[whole], doc[whole]
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        own = [gram_hashes(words.hash[words.starts[d]:words.starts[d + 1]], int(count[d]))[0] + np.uint64(count[d]) for d in short]
        h, doc = np.concatenate((h, np.array(own, np.uint64))), np.concatenate((doc, short))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = runs(doc, h)
    h, doc = h[first], doc[first]
    return h, np.searchsorted(doc, np.arange(len(texts) + 1))


def signatures(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, SYMBOLS) minima; rows of empty sets are zero."""
    out = np.zeros((len(starts) - 1, SYMBOLS), np.uint16)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        for i, f in enumerate(FACTORS):
            out[full, i] = mix(np.minimum.reduceat(h * f, starts[full])) & np.uint64(0xFFFF)
    return out


def _sets(batches):
    """(rows, hashes, starts) of runs of documents of bounded size."""
    for pdf in batches:
        texts, first, held = [], 0, 0
        for i, x in enumerate(pdf["text"]):
            texts.append(x.encode("utf-8", "replace") if isinstance(x, str) else b"")
            held += len(texts[-1])
            if held >= BATCH_BYTES or i + 1 == len(pdf):
                yield pdf.iloc[first:i + 1], *shingle_sets(texts)
                texts, first, held = [], i + 1, 0


def _set_key(h: np.ndarray, a: int, b: int) -> bytes:
    return hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest()


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc_id")


def _ids(ids: np.ndarray) -> pd.Series:
    return pd.Series(ids, dtype="Int64").mask(ids == NO_ID)


def _key() -> Column:
    return text_key(F.coalesce(F.col("text"), F.lit("")))


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, a, b, n, n_shingles, set_key, signature) per document row: a, b, n are the text's key; no set key for an empty set."""
    def made(batches):
        for rows, h, starts in _sets(batches):
            sig = signatures(h, starts)
            size = np.diff(starts)
            yield pd.DataFrame({"doc_id": _ids(rows["doc_id"].to_numpy()), "a": rows["a"].to_numpy(), "b": rows["b"].to_numpy(),
                                "n": rows["n"].to_numpy(), "n_shingles": size,
                                "set_key": [_set_key(h, a, b) if b > a else None for a, b in zip(starts, starts[1:])],
                                "signature": [x.tobytes() for x in sig]})
    # ids without nulls: pandas would turn them into floats
    return docs.select(_id(), "text", _key().alias("k")).select("doc_id", "text", "k.*").mapInPandas(
        made, "doc_id long, a long, b long, n int, n_shingles long, set_key binary, signature binary")


def read_signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, SYMBOLS)


def chunk_keys(sig: np.ndarray, most: int = DISTANCE) -> np.ndarray:
    """(classes, SYMBOLS) keys: each chunk's symbols with one of them left out."""
    chunks = most // (ERRORS + 1) + 1
    bounds = [SYMBOLS * i // chunks for i in range(chunks + 1)]
    up, _ = powers(SYMBOLS)
    value = (sig.astype(np.uint64) + np.uint64(1)) * up[:SYMBOLS]
    out = np.empty(sig.shape, np.uint64)
    for a, b in zip(bounds, bounds[1:]):
        whole = value[:, a:b].sum(axis=1, dtype=np.uint64)
        out[:, a:b] = whole[:, None] - value[:, a:b]
    return mix(out + np.arange(SYMBOLS, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def forest(n: int, linked) -> list[tuple[int, int]]:
    """Links of a spanning forest; ``linked(x, others)`` tells which of the others x is linked with."""
    left, out = np.arange(n), []
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            x = todo.pop()
            hit = linked(x, left)
            out += [(x, int(y)) for y in left[hit]]
            todo += left[hit].tolist()
            left = left[~hit]
    return out


def near(sig: np.ndarray, most: int):
    return lambda x, others: (sig[others] != sig[x]).sum(axis=1) <= most


def similar(sets: list[np.ndarray], percent: int):
    """Confirmed on the full sets, sizes first."""
    size = np.array([len(s) for s in sets])

    def linked(x: int, others: np.ndarray) -> np.ndarray:
        most, least = np.maximum(size[others], size[x]), np.minimum(size[others], size[x])
        hit = 100 * least >= percent * most
        at = np.flatnonzero(hit)
        if len(at):
            mine, theirs = sets[x], np.concatenate([sets[i] for i in others[at]])
            found = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
            lengths = size[others[at]]
            both = np.add.reduceat(found.astype(np.int64), np.cumsum(lengths) - lengths)
            hit[at] = 100 * both >= percent * (lengths + size[x] - both)
        return hit
    return linked


def _groups(batches, keys: list[str]):
    """The rows of each group of a partition that is sorted by ``keys``, in frames of many whole groups."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        first = runs(*(pdf[k].to_numpy() for k in keys))
        if len(first):
            if len(first) > 1:
                yield pdf.iloc[:first[-1]], first[:-1]
            rest = pdf.iloc[first[-1]:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest, np.zeros(1, np.int64)


def hamming(percent: int):
    """(distances, linked, in reach) of signatures from a pivot's."""
    most = distance(percent)

    def of(pivot: bytes, others: list[bytes]):
        d = (read_signatures(others) != np.frombuffer(pivot, np.uint16)).sum(axis=1)
        return d.astype(float), d <= most, d <= 2 * most
    return of


def jaccard(percent: int):
    """(distances, linked, in reach) of shingle sets from a pivot's."""
    def of(pivot: bytes, others: list[bytes]):
        mine, sets = np.frombuffer(pivot, np.uint64), [np.frombuffer(x, np.uint64) for x in others]
        theirs, lengths = np.concatenate(sets), np.array([len(s) for s in sets])
        found = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
        both = np.add.reduceat(found.astype(np.int64), np.cumsum(lengths) - lengths)
        union = lengths + len(mine) - both
        # twice the distance: 1 - both / union <= 2 (1 - percent / 100)
        return 1 - both / union, 100 * both >= percent * union, 100 * (union - both) <= 2 * (100 - percent) * union
    return of


def _against_pivots(of):
    def run(batches):
        for pdf in batches:
            out = []
            for _, own in pdf.groupby("pivot", sort=False):
                d, linked, reach = of(own["pivot_payload"].iloc[0], list(own["payload"]))
                out.append(own[["grp", "cls", "payload", "pivot"]].assign(d=d, linked=linked, reach=reach))
            if out:
                yield pd.concat(out, ignore_index=True)
    return run


def pivot_rounds(members: DataFrame, of) -> tuple[DataFrame, DataFrame]:
    """(met, rest) of large groups' (grp, cls, payload): every meeting of a member with a pivot, and who is left after ROUNDS."""
    rest, met = members.select("grp", "cls", "payload"), None
    for _ in range(ROUNDS):
        pivot = F.min(F.struct("cls", "payload")).alias("p")
        pivots = (rest.groupBy("grp").agg(pivot).select(
            F.col("grp").alias("g"), F.col("p")["cls"].alias("pivot"), F.col("p")["payload"].alias("pivot_payload"),
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s")))
        pairs = rest.join(pivots, (F.col("grp") == F.col("g")) & (F.pmod(F.xxhash64("cls"), F.lit(SALTS)) == F.col("s")))
        round_ = materialise(pairs.select("grp", "cls", "payload", "pivot", "pivot_payload").mapInPandas(
            _against_pivots(of), "grp long, cls long, payload binary, pivot long, d double, linked boolean, reach boolean"))
        met = round_ if met is None else met.unionByName(round_)
        rest = round_.where(~F.col("linked")).select("grp", "cls", "payload")
    return met, rest


def shell_links(met: DataFrame, percent: int) -> DataFrame:
    """Links between those near a pivot and those in its shell, by tiles of both; one is enough for each of the shell."""
    near_, shell = met.where("linked"), met.where("reach AND NOT linked")
    per = shell.groupBy("pivot").agg(F.count("*").alias("n_shell"), F.min("d").alias("low"))
    per = per.join(near_.groupBy("pivot").agg(F.count("*").alias("n_near")), "pivot")
    tiles = lambda n: F.ceil(F.col(n) / F.lit(TILE)).cast("int")
    own = lambda n: F.pmod(F.xxhash64("cls"), tiles(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), tiles(n) - 1))
    # x is linked with y only if d(x, pivot) >= d(y, pivot) - distance
    inner = (near_.join(per, "pivot").where(F.col("d") >= F.col("low") - (1 - percent / 100) - 1e-9)
             .withColumn("tile_a", own("n_near")).withColumn("tile_b", every("n_shell")).withColumn("outer", F.lit(False)))
    outer = (shell.join(per, "pivot").withColumn("tile_b", own("n_shell")).withColumn("tile_a", every("n_near")).withColumn("outer", F.lit(True)))
    both = inner.select("pivot", "tile_a", "tile_b", "outer", "cls", "payload").unionByName(
        outer.select("pivot", "tile_a", "tile_b", "outer", "cls", "payload"))

    def link(batches):
        for pdf, first in _groups(batches, ["pivot", "tile_a", "tile_b"]):
            links = []
            for a, b in zip(first, np.append(first[1:], len(pdf))):
                rows = pdf.iloc[a:b]
                cls, outside = rows["cls"].to_numpy(), rows["outer"].to_numpy(bool)
                linked, inside = similar([np.frombuffer(x, np.uint64) for x in rows["payload"]], percent), np.flatnonzero(~outside)
                for y in np.flatnonzero(outside) if len(inside) else []:
                    hit = np.flatnonzero(linked(y, inside))
                    if len(hit):
                        links.append((cls[inside[hit[0]]], cls[y]))
            yield pd.DataFrame(links, columns=["a", "b"])
    return _grouped(both, ["pivot", "tile_a", "tile_b"]).mapInPandas(link, "a long, b long")


def tiled(members: DataFrame, key: str, size: str) -> DataFrame:
    """``members`` with (tile_a, tile_b): a group over TILE is dealt into tiles, every pair of them a group."""
    tiles = F.ceil(F.col(size) / F.lit(TILE)).cast("int")
    own = F.pmod(F.xxhash64("cls"), tiles).cast("int")
    return (members.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), tiles - 1)))
            .withColumn("tile_a", F.least("_own", "_other")).withColumn("tile_b", F.greatest("_own", "_other")).drop("_own", "_other"))


def _with_sizes(rest: DataFrame) -> DataFrame:
    """``rest`` with ``n``, the members that its group has left; salted, as one group may have most of them."""
    sizes = rest.groupBy("grp").agg(F.count("*").cast("int").alias("n"))
    spread = sizes.select(F.col("grp").alias("g"), "n", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    return rest.join(spread, (F.col("grp") == F.col("g")) & (F.pmod(F.xxhash64("cls"), F.lit(SALTS)) == F.col("s"))).drop("g", "s")


def _grouped(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)


def _signature_links(most: int):
    def link(batches):
        for pdf, first in _groups(batches, ["key", "tile_a", "tile_b"]):
            cls = pdf["cls"].to_numpy()
            sig = read_signatures(pdf["signature"])
            ends = np.append(first[1:], len(pdf))
            two = first[ends - first == 2]
            two = two[(sig[two] != sig[two + 1]).sum(axis=1) <= most]
            links = [np.stack((cls[two], cls[two + 1]), axis=1)]
            for a, b in zip(first, ends):
                if b - a > 2:
                    got = forest(b - a, near(sig[a:b], most))
                    if got:
                        links.append(cls[a:b][np.array(got)])
            yield pd.DataFrame(np.concatenate(links), columns=["a", "b"])
    return link


def _set_links(percent: int):
    def confirm(batches):
        for pdf, first in _groups(batches, ["root", "tile_a", "tile_b"]):
            links = [np.zeros((0, 2), np.int64)]
            for a, b in zip(first, np.append(first[1:], len(pdf))):
                rows = pdf.iloc[a:b].drop_duplicates("cls")
                cls = rows["cls"].to_numpy()
                got = forest(len(rows), similar([np.frombuffer(x, np.uint64) for x in rows["shingles"]], percent))
                if got:
                    links.append(cls[np.array(got)])
            yield pd.DataFrame(np.concatenate(links), columns=["a", "b"])
    return confirm


def _linked(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """What ``describe`` tells of the documents, and (set_key, rep, root) of every class: its least id and its component."""
    described = materialise(describe(docs))
    classes = materialise(described.where(F.col("set_key").isNotNull()).groupBy("set_key")
                          .agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
                          .withColumn("cls", F.monotonically_increasing_id()))

    most = distance(percent)

    def keys_of(batches):
        for pdf in batches:
            keys = chunk_keys(read_signatures(pdf["signature"]), most)
            yield pd.DataFrame({"key": keys.ravel().view(np.int64), "cls": np.repeat(pdf["cls"].to_numpy(), SYMBOLS)})

    keys = classes.select("cls", "signature").mapInPandas(keys_of, "key long, cls long")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialise(shared)
    small = shared.where(F.col("n") <= LARGE * TILE)
    members = lambda some: keys.join(some, "key").join(classes.select("cls", "signature"), "cls")
    alike = lambda some: _grouped(tiled(some, "key", "n"), ["key", "tile_a", "tile_b"]).mapInPandas(_signature_links(most), "a long, b long")
    links = alike(members(small))
    if small.count() < shared.count():
        large = members(shared.where(F.col("n") > LARGE * TILE)).select(F.col("key").alias("grp"), "cls", F.col("signature").alias("payload"))
        met, rest = pivot_rounds(materialise(large), hamming(percent))
        links = links.unionByName(met.where("reach AND cls <> pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b")))
        links = links.unionByName(alike(_with_sizes(rest).select(F.col("grp").alias("key"), "n", "cls", F.col("payload").alias("signature"))))
    families = materialise(components(links))

    sized = families.join(families.groupBy("root").agg(F.count("*").alias("n")), "root")
    wanted = materialise(sized.join(classes, F.col("node") == F.col("cls")).select("root", "n", "cls", "set_key", "rep"))
    ids = wanted.select(F.coalesce("rep", F.lit(int(NO_ID))).alias("_id")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        ids, F.coalesce("doc_id", F.lit(int(NO_ID))) == F.col("_id"), "left_semi")

    def sets_of(batches):
        for _, h, starts in _sets(batches):
            spans = [(a, b) for a, b in zip(starts, starts[1:]) if b > a]
            yield pd.DataFrame({"set_key": [_set_key(h, a, b) for a, b in spans], "shingles": [h[a:b].tobytes() for a, b in spans]})

    # a class's set comes from a document with its representative's id and the same set
    sets = texts.mapInPandas(sets_of, "set_key binary, shingles binary")
    in_families = wanted.drop("rep").join(sets, "set_key").select("root", "n", "cls", "shingles")
    confirm = lambda some: _grouped(tiled(some, "root", "n"), ["root", "tile_a", "tile_b"]).mapInPandas(_set_links(percent), "a long, b long")
    if wanted.where(F.col("n") > LARGE * TILE).isEmpty():
        confirmed = confirm(in_families)
    else:
        in_families = materialise(in_families)
        # a set may come from several documents with the representative's id
        large = (in_families.where(F.col("n") > LARGE * TILE).groupBy(F.col("root").alias("grp"), "cls").agg(F.first("shingles").alias("payload")))
        met, rest = pivot_rounds(materialise(large), jaccard(percent))
        near_ = met.where("linked AND cls <> pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b"))
        rest = _with_sizes(rest).select(F.col("grp").alias("root"), "n", "cls", F.col("payload").alias("shingles"))
        confirmed = (confirm(in_families.where(F.col("n") <= LARGE * TILE)).unionByName(near_).unionByName(shell_links(met, percent))
                     .unionByName(confirm(rest)))
    groups = components(confirmed)

    return described, classes.join(groups, F.col("cls") == F.col("node"), "left").select("set_key", "rep", F.coalesce("root", "cls").alias("root"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document row."""
    described, of_class = _linked(docs, percent)
    least = of_class.groupBy("root").agg(F.min("rep").alias("component"))
    of_class = of_class.join(least, "root").select("set_key", "component")
    found = described.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component and all without words, with the columns they came with.

    The row with the least id stays, of several the one with the least text
    key, of rows equal in both the one whose columns hash least.
    """
    described, of_class = _linked(docs, percent)
    row = F.struct(F.coalesce("doc_id", F.lit(int(NO_ID))).alias("id"), F.struct("a", "b", "n").alias("key"))
    texts = described.where(F.col("set_key").isNotNull()).groupBy("set_key", row.alias("__row")).agg(F.count("*").alias("__copies"))
    # a class's least row first: hot classes and components are combined before the shuffles
    firsts = of_class.join(texts.groupBy("set_key").agg(F.min("__row").alias("first")), "set_key").select("set_key", "root", "first")
    firsts = firsts.join(firsts.groupBy("root").agg(F.min("first").alias("__first")), "root").select("set_key", "__first")
    verdict = materialise(texts.join(firsts, "set_key").select("__row", (F.col("__row") == F.col("__first")).alias("__stays"), "__copies")
                          .where("__copies > 1 OR NOT __stays").select("__row.id", "__row.key", "__stays")
                          .toDF("__id", "__key", "__stays"))
    same = (_id() == F.col("__id")) & (_key() == F.col("__key"))
    stay = docs.join(verdict, same, "left_anti")
    several = verdict.where("__stays")
    if several.isEmpty():
        return stay
    # rows equal in id and text: each task sends one of them
    plain = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    one = (docs.join(several, same, "left_semi").groupBy(_id().alias("__id"), _key().alias("__key"))
           .agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("__whole")).select("__whole.*"))
    return stay.unionByName(one)
