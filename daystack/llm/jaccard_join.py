"""Jaccard similarity join on word shingles with adaptive multi-match prefixes.

Shingles are ordered from rare to frequent.  If two sets are similar enough, then for every k they
share at least k shingles of each one's prefix, which is (size - least overlap + k) long.  Each set
picks its own k by what its prefix would cost: a longer one meets more sets, but asks for more shared
shingles and so sends fewer to verification.  A pair must share as many as the smaller k of the two,
within the prefixes that its own sizes ask for, which are shorter still.

Texts' sets are compared, not texts: equal sets are one.  Shingles travel once, packed by ranges of
hashes; where they meet, those that no other set has go no further.  They come first in every prefix,
so a set with more of them than its prefix holds is done.  Links give components, and components save
work: groups of near copies join up by stars around one member each, and from then on only frequent
enough encounters between different components are verified, all of them.

Edge cases: a text without words, empty or null, has no shingles and is linked with nothing; a text of
any length gives all its shingles; equal texts and repeated rows share a component; a component is named by its
smallest doc_id, so there are no ties; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystack.llm.common import cut, look_up, release, texts, unused
from daystack.llm.components import components
from daystack.llm.shingles import SIGNATURE, WORDS, mixed, shingle_set, signature

PERCENT = 75
#: Shingles that a task holds before it sends them on.
HELD = 1_500_000
#: The longest match that prefixes are lengthened for, and what verifying a pair costs in lookups.
LONGEST, VERIFY = 8, 20
#: A shingle within its range: so many bits travel.  With 50 ranges, of two sets of 600 shingles the overlap is off
#: by one in about 1 of 10^8 pairs; more ranges make it rarer.
BITS = 40
#: Bytes of packed shingles in a range, about; a range is what a task holds at once, so there are more with more input.
RANGE_BYTES = 8 << 20


def document_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, sig: the set's signature in hex, null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t, words) for t in b.column(1).to_pylist()]
            sig = [signature(s).hex() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, sets), pa.int64()), pa.array(sig, pa.string())], ["doc_id", "n_shingles", "sig"])

    return texts(docs).mapInArrow(run, "doc_id long, n_shingles long, sig string")


# ---------------------------------------------------------------- shingles, packed by range


def pack_ranges(sets: list[tuple[bytes, np.ndarray]], ranges: int) -> Iterator[tuple[int, bytes]]:
    """(range, bytes): sets' number, signatures, counts of shingles in the range, and these."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for _, s in sets])
    tokens = np.concatenate([s for _, s in sets])
    sigs = np.frombuffer(b"".join(s for s, _ in sets), np.uint8).reshape(-1, SIGNATURE)
    part = ((tokens >> np.uint64(BITS)) % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    tokens, owner, part = tokens[order], owner[order], part[order]
    bounds = np.searchsorted(part, np.arange(ranges + 1))
    for r in range(ranges):
        lo, hi = bounds[r], bounds[r + 1]
        if lo == hi:
            continue
        starts = np.flatnonzero(np.concatenate([[True], owner[lo + 1 : hi] != owner[lo : hi - 1]]))
        counts = np.diff(np.append(starts, hi - lo)).astype("<u4")
        low = np.ascontiguousarray(tokens[lo:hi]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : BITS // 8]
        yield r, b"".join((np.uint32(len(counts)).tobytes(), sigs[owner[lo:hi][starts]].tobytes(), counts.tobytes(), low.tobytes()))


def unpack_range(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures (rows of bytes), counts, shingles."""
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    sigs = np.frombuffer(blob, np.uint8, n * SIGNATURE, 4).reshape(-1, SIGNATURE)
    counts = np.frombuffer(blob, "<u4", n, 4 + n * SIGNATURE)
    low = np.frombuffer(blob, np.uint8, offset=4 + n * (SIGNATURE + 4)).reshape(-1, BITS // 8)
    tokens = np.zeros((len(low), 8), np.uint8)
    tokens[:, : BITS // 8] = low
    return sigs, counts.astype(np.int64), tokens.view("<u8").ravel()


def group_of(sigs: np.ndarray, groups: int) -> np.ndarray:
    return np.ascontiguousarray(sigs[:, :4]).view(">u4").ravel().astype(np.int64) % groups


def pack_sets(r: int, sigs: np.ndarray, owner: np.ndarray, tokens: np.ndarray, df: np.ndarray) -> bytes:
    """One range's shingles of some sets, and their frequencies."""
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    counts = np.diff(np.append(starts, len(owner))).astype("<u4")
    low = np.ascontiguousarray(tokens).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : BITS // 8]
    return b"".join((np.uint32(len(counts)).tobytes(), np.uint32(r).tobytes(), sigs[owner[starts]].tobytes(), counts.tobytes(), low.tobytes(), df.tobytes()))


def unpack_sets(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, counts, shingles (the range in their high bits), frequencies."""
    n, r = (int(x) for x in np.frombuffer(blob, "<u4", 2))
    at = 8 + n * (SIGNATURE + 4)
    sigs = np.frombuffer(blob, np.uint8, n * SIGNATURE, 8).reshape(-1, SIGNATURE)
    counts = np.frombuffer(blob, "<u4", n, 8 + n * SIGNATURE).astype(np.int64)
    m = int(counts.sum())
    tokens = np.zeros((m, 8), np.uint8)
    tokens[:, : BITS // 8] = np.frombuffer(blob, np.uint8, m * (BITS // 8), at).reshape(-1, BITS // 8)
    return sigs, counts, tokens.view("<u8").ravel() + np.uint64(r << BITS), np.frombuffer(blob, "<u4", m, at + m * (BITS // 8)).astype(np.int64)


def shared_shingles(docs: DataFrame, ranges: int, words: int) -> DataFrame:
    """(group of signatures, bytes): of each set, the shingles that some other set has, and how many sets have them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, np.ndarray]] = []
        seen: set[bytes] = set()
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            for r, blob in pack_ranges(held, ranges) if held else ():
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([blob], pa.binary())], ["r", "blob"])
            held.clear()

        for b in batches:
            for text in b.column(1).to_pylist():
                s = shingle_set(text, words)
                if len(s) and (sig := signature(s)) not in seen:
                    seen.add(sig)
                    held.append((sig, s))
                    n += len(s)
                    if n > HELD:
                        yield from out()
                        n = 0
        yield from out()

    def meet(table: pa.Table) -> pa.Table:
        r = table.column("r")[0].as_py()
        parts = [unpack_range(x) for x in table.column("blob").to_pylist()]
        sigs, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        tokens = np.concatenate([p[2] for p in parts])
        del parts
        # a set that several tasks sent has the same shingles each time: one copy counts
        low = np.ascontiguousarray(sigs[:, :8]).view("<u8").ravel()
        high = np.ascontiguousarray(sigs[:, 8:]).view("<u2").ravel()
        order = np.lexsort((high, low))
        fresh = np.concatenate([[True], (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])])
        first = np.zeros(len(sigs), bool)
        first[order[fresh]] = True
        tokens, owner = tokens[np.repeat(first, counts)], np.repeat(np.flatnonzero(first), counts[first])
        order = np.argsort(tokens)
        t = tokens[order]
        starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        df = np.empty(len(t), np.int64)
        df[order] = np.repeat(np.diff(np.append(starts, len(t))), np.diff(np.append(starts, len(t))))
        some = df > 1
        tokens, owner, df = tokens[some], owner[some], df[some].astype("<u4")  # each owner's are together still
        group = group_of(sigs, ranges)[owner]
        order = np.argsort(group, kind="stable")
        tokens, owner, df, group = tokens[order], owner[order], df[order], group[order]
        bounds = np.searchsorted(group, np.arange(ranges + 1))
        found = [(g, pack_sets(r, sigs, owner[lo:hi], tokens[lo:hi], df[lo:hi])) for g, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)) if lo < hi]
        return pa.table({"g": pa.array([g for g, _ in found], pa.int64()), "blob": pa.array([x for _, x in found], pa.binary())})

    sent = texts(docs).mapInArrow(send, "r int, blob binary").repartitionById(ranges, F.col("r"))
    return sent.groupBy("r").applyInArrow(meet, "g long, blob binary")


# ---------------------------------------------------------------- prefixes


def adaptive_prefix(size: int, tokens: np.ndarray, df: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """(prefix, k) of a set of ``size`` with the shared ``tokens``; an empty prefix when nothing can link with it."""
    alone = size - len(tokens)
    base = size - -(-percent * size // 100) - alone  # shared shingles in a prefix for k = 0
    if base < 0:
        return tokens[:0], 0
    order = np.lexsort((mixed(tokens), df))
    tokens, df = tokens[order], df[order]
    meets = np.cumsum(df - 1)
    ks = np.arange(1, min(LONGEST, len(tokens) - base) + 1)
    if not len(ks):
        return tokens[:0], 0
    met = meets[base + ks - 1]
    k = int(ks[np.argmin(met + VERIFY * met / ks)])
    return tokens[: base + k], k


def candidates(docs: DataFrame, sets: DataFrame, ranges: int, words: int, percent: int) -> DataFrame:
    """id, n, toks, prefix, k, alone, bucket: the sets that may have a link; bucket is a min-hash of toks."""
    group = F.conv(F.substr("sig", F.lit(1), F.lit(8)), 16, 10).cast("long") % ranges
    names = ["id", "n", "toks", "prefix", "k", "alone", "bucket"]
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.int64())

    def choose(blobs: pa.Table, known: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if blobs.num_rows:
            parts = [unpack_sets(x) for x in blobs.column("blob").to_pylist()]
            sigs, counts, tokens, df = (np.concatenate([p[k] for p in parts]) for k in range(4))
            info = {bytes.fromhex(s): (i, n) for s, i, n in zip(*(known.column(c).to_pylist() for c in ("sig", "id", "n")), strict=True)}
            number = {s: k for k, s in enumerate(info)}
            owner = np.repeat([number[s.tobytes()] for s in sigs], counts)
            order = np.argsort(owner, kind="stable")
            tokens, df, owner = tokens[order], df[order], owner[order]
            bounds = np.searchsorted(owner, np.arange(len(info) + 1))
            for k, (id_, n) in enumerate(info.values()):
                t, d = tokens[bounds[k] : bounds[k + 1]], df[bounds[k] : bounds[k + 1]]
                prefix, need = adaptive_prefix(n, t, d, percent)
                if need:
                    out.append((id_, n, t.view(np.int64), prefix.view(np.int64), need, n - len(t), int(mixed(t + np.uint64(1)).min().view(np.int64))))
        cols = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    # groups are numbers below ``ranges``: one task each
    by_group = lambda rows: rows.repartitionById(ranges, F.col("g").cast("int")).groupBy("g")
    blobs = by_group(shared_shingles(docs, ranges, words))
    return blobs.cogroup(by_group(sets.withColumn("g", group))).applyInArrow(choose, "id long, n long, toks array<bigint>, prefix array<bigint>, k int, alone long, bucket long")


# ---------------------------------------------------------------- links


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough, by whole sets."""
    of = lambda x: sets.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("toks").alias(f"toks_{x}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a").withColumn("both", F.size(F.array_intersect("toks_a", "toks_b")))
    return both.where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def star_pairs(rows: DataFrame, key: str) -> DataFrame:
    """For each key, the row with the fewest shingles of its own, paired with one row of each other component."""
    one = rows.groupBy(key, "root").agg(F.min(F.struct("alone", "id")).alias("one"))
    hub = one.groupBy(key).agg(F.min(F.struct("one", "root")).alias("hub"), F.count("*").alias("roots")).where("roots > 1")
    return one.join(hub, key).where(F.col("root") != F.col("hub.root")).select(F.col("hub.one.id").alias("a"), F.col("one.id").alias("b")).distinct()


def similar_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, root): components of the links between candidate sets."""
    alone = sets.select("id", "alone", "bucket", F.col("id").alias("root"))
    links = cut(verified(star_pairs(alone, "bucket"), sets, percent))
    roots = cut(components(links))

    def rooted(rows: DataFrame) -> DataFrame:
        return rows.join(roots.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").withColumn("root", F.coalesce("root", "id")).drop("_id")

    prefixes = rooted(sets.select("id", "n", "k", "alone", "prefix"))
    prefixes = prefixes.select("id", "n", "k", "alone", "root", F.posexplode("prefix").alias("at", "tok")).withColumn("at", F.col("at") + F.col("alone"))
    while True:
        mixed_toks = prefixes.groupBy("tok").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("tok")
        prefixes = cut(prefixes.join(mixed_toks, "tok", "left_semi"))  # shingles that still lead from one component to another
        fresh = cut(verified(star_pairs(prefixes, "tok"), sets, percent))
        if fresh.isEmpty():
            break
        links = cut(links.unionByName(fresh))
        roots = cut(components(links))
        prefixes = rooted(prefixes.drop("root"))
        release(sets.sparkSession)

    if prefixes.isEmpty():
        return roots

    # what still meets: each set is compared with a pivot, of the sets that it meets the one with the most links
    degree = links.groupBy(F.col("a").alias("_id")).agg(F.count("*").alias("_links"))
    ranked = prefixes.join(degree, F.col("id") == F.col("_id"), "left").withColumn("one", F.struct((-F.coalesce("_links", F.lit(0))).alias("links"), "alone", "id"))
    hubs = ranked.groupBy("tok").agg(F.min("one").alias("hub"))
    pivots = prefixes.select("id", "tok").join(hubs, "tok").groupBy("id").agg(F.min("hub").alias("hub")).select("id", F.col("hub.id").alias("pivot"))
    of = lambda x: sets.select(F.col("id").alias(f"_{x}"), F.col("n").alias(f"n_{x}"), F.col("toks").alias(f"toks_{x}"))
    seen = pivots.join(of("own"), F.col("id") == F.col("_own")).join(of("pivot"), F.col("pivot") == F.col("_pivot"))
    seen = cut(seen.select("id", "pivot", F.col("n_own").alias("n"), "n_pivot", F.size(F.array_intersect("toks_own", "toks_pivot")).alias("shared"), F.array_except("toks_own", "toks_pivot").alias("rest")))
    found = seen.where((F.col("id") != F.col("pivot")) & (100 * F.col("shared") >= percent * (F.col("n") + F.col("n_pivot") - F.col("shared"))))
    links = cut(links.unionByName(found.select(F.col("pivot").alias("a"), F.col("id").alias("b"))))
    roots = cut(components(links))
    seen = rooted(seen)

    # Two sets with one pivot share at most the lesser of what they share with it, and what they share
    # besides.  ``needed`` is (100 + percent) times the least that similar sets share.
    needed = percent * (F.col("n_a") + F.col("n_b"))
    besides = needed > (100 + percent) * F.least("shared_a", "shared_b")
    side = lambda x: seen.select("pivot", F.explode("rest").alias("tok"), *[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "shared", "root")])
    met = side("a").join(side("b"), ["pivot", "tok"]).where((F.col("root_a") < F.col("root_b")) & besides)
    met = met.groupBy(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "n_a", "n_b", "shared_a", "shared_b").count()
    pairs = met.where(needed <= (100 + percent) * (F.least("shared_a", "shared_b") + F.col("count"))).select("a", "b")

    # All others by a pair's own prefixes: of a set of n that must share at least m with the other, n - m + k,
    # and no set has more than n - m shingles alone.
    rest = rooted(prefixes.drop("root")).join(seen.select(F.col("id").alias("_id"), "pivot", "shared"), F.col("id") == F.col("_id"))
    side = lambda x: rest.select("tok", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "k", "alone", "at", "root", "pivot", "shared")])
    within = lambda x: (needed <= (100 + percent) * (F.col(f"n_{x}") + F.least("k_a", "k_b") - F.col(f"at_{x}") - 1)) & (needed <= (100 + percent) * (F.col(f"n_{x}") - F.col(f"alone_{x}")))
    met = side("a").join(side("b"), "tok").where((F.col("root_a") < F.col("root_b")) & within("a") & within("b") & ~((F.col("pivot_a") == F.col("pivot_b")) & besides))
    met = met.groupBy(F.col("id_a").alias("a"), F.col("id_b").alias("b"), F.least("k_a", "k_b").alias("least")).count().where("count >= least")
    pairs = cut(pairs.unionByName(met.select("a", "b")))
    return components(cut(links.unionByName(verified(pairs, sets, percent))))


def shingle_ranges(rows: DataFrame) -> int:
    """How many ranges the shingles of ``rows`` (n_shingles) are dealt to: by their bytes, and one for each task at least."""
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total * (BITS // 8) // RANGE_BYTES))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links lead to)."""
    rows = cut(document_sets(docs, words))
    sets = rows.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.count("*").alias("copies"))
    sets = cut(sets)
    release(docs.sparkSession)
    ranges = shingle_ranges(rows)
    some = cut(candidates(docs, sets.drop("copies"), ranges, words, percent))
    roots = similar_links(some, percent)
    known = sets.join(roots, "id", "left").select("sig", "copies", F.coalesce("root", "id").alias("component_id"), "root")
    known = known.where("copies > 1 or root is not null").drop("root")
    # without a set, or with one of its own, a document needs no answer; its key is in no table
    keyed = rows.withColumn("sig", F.coalesce("sig", F.concat(F.lit("-"), F.col("doc_id").cast("string"))))
    out = look_up(keyed, known, "sig", "copies")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_similar(docs: DataFrame) -> DataFrame:
    """``docs`` with all their columns, one document of each component: the one with the smallest doc_id.

    Rows without a doc_id are in no component and stay; so do rows without words, and rows that share
    the doc_id of one that stays.  Columns may have any names.
    """
    key = unused(docs, "_kept_id")
    kept = jaccard_components(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept[key]), "left_semi")
