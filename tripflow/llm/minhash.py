"""MinHash near-duplicates with sequential Bayesian verification.

A document is a set of shingles, its signature one byte of each of many minima over the set. Bands of
the signature put sets into buckets; sets of the wanted similarity share none of the bands with a
probability under 4e-9. Candidates are verified in steps: after every batch of the signature the
matches so far give the posterior distribution of the similarity (uniform prior), and a pair whose
probability of reaching the wanted similarity falls below the chosen miss probability goes. What is
left is verified exactly on the whole sets.

A bucket doesn't give all its pairs. Its sets are first paired with the one that shares most buckets,
each set with its best partner first; linked sets become one component, and only pairs across
components are looked at after that. A bucket that still holds many sets of different components is
not paired up: its sets are joined on the rare shingles that linked sets must share. Both joins apply the
posterior bound to one bit of each place of the signatures, so a pair they rule out is never a row.

Entries of bands are dealt out by ranges of (band, set), so a bucket of any size lies spread over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.components import components
from tripflow.llm.tables import stored
from tripflow.llm.words import Texts, groups, mix

SHINGLE = 2
# Similarity as a fraction of whole numbers, so that bounds are exact.
SIMILARITY = (80, 100)
BANDS, BAND_SIZE = 64, 6
# Places of the signature that are compared before the posterior is looked at again.
BATCH = 32
MISS = 1e-9
# Sets of a bucket that are paired up; larger ones go through their rare shingles.
PAIRED = 8

_ROWS = "row_id long, t1 long, t2 long, n long, c1 long, c2 long, signature binary"
_rng = np.random.default_rng(20250311)
_FACTORS = _rng.integers(0, 2**31, BANDS * BAND_SIZE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _rng.integers(0, 2**32, BANDS * BAND_SIZE, dtype=np.uint32)


def _sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a group of texts: text and hash of each, ascending."""
    found = Texts(texts, lower=True)
    start, text, length = found.windows(shingle, whole_if_shorter=True)
    hashes = found.hashes(start, length)
    edges = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
    for i in range(len(texts)):
        hashes[edges[i] : edges[i + 1]].sort()
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One byte of each minimum of the sets ``hashes[first[i]:first[i + 1]]``; zeros for empty sets."""
    out = np.zeros((len(first) - 1, len(_FACTORS)), np.uint8)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        at = first[full]
        for k in range(len(_FACTORS)):
            least = np.minimum.reduceat(low * _FACTORS[k] + _SHIFTS[k], at)
            out[full, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return out


def _signer(shingle: int):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            text, hashes = _sets(batch.column("text"), shingle)
            n = np.bincount(text, minlength=batch.num_rows)
            first = np.concatenate(([0], np.cumsum(n)))
            sums = []
            for salt in (0x8A5CD789635D2DFF, 0x121FD2155C472F96):
                total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)), dtype=np.uint64)))
                sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            signature = pa.array([s.tobytes() for s in signatures(hashes, first)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("t1"), batch.column("t2"), pa.array(n.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), signature],
                names=["row_id", "t1", "t2", "n", "c1", "c2", "signature"],
            )

    return signed


def _bytes_of(column: pa.Array, width: int) -> np.ndarray:
    """A row per value, all of them of one width."""
    column = column.cast(pa.large_binary())
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    start = column.offset and np.frombuffer(column.buffers()[1], np.int64)[column.offset]
    return data[start : start + len(column) * width].reshape(len(column), width)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, r): a band is its number and its bytes of the signature."""
    for batch in batches:
        found = _bytes_of(batch.column("signature"), BANDS * BAND_SIZE).reshape(-1, BANDS, BAND_SIZE)
        keys = np.zeros((len(found), BANDS, 8), np.uint8)
        keys[:, :, :BAND_SIZE] = found
        keys[:, :, 6] = np.arange(BANDS)
        r = np.repeat(np.asarray(batch.column("r")), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1, 8).view(np.int64).reshape(-1)), pa.array(r)], names=["band", "r"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted entries, those whose band holds another, and the first and last of the task, whose
    neighbours another task has."""
    held: tuple | None = None  # the last entry so far, and whether it has been found to be shared
    first = True
    for batch in batches:
        band, r = (np.asarray(batch.column(i)) for i in (0, 1))
        if not len(band):
            continue
        same = band[1:] == band[:-1]
        keep = np.zeros(len(band), bool)
        keep[1:] |= same
        keep[:-1] |= same
        if held is not None:
            met = held[0] == band[0]
            keep[0] |= met
            if held[2] or met:
                yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]])], names=["band", "r"])
        keep[0] |= first
        first = False
        held = (band[-1], r[-1], keep[-1])
        keep[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(band[keep]), pa.array(r[keep])], names=["band", "r"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]])], names=["band", "r"])


def least_matches(size: int, batch: int, similarity: tuple[int, int], miss: float) -> list[tuple[int, int]]:
    """(places compared, matches needed) after each batch.

    With m matches of n the posterior is Beta(m + 1, n - m + 1); it lies at or above t with the
    probability that n + 1 throws of probability t give m successes at most.
    """
    hit, whole = similarity
    out = []
    for n in range(batch, size + 1, batch):
        total, m = 0, 0
        most = whole ** (n + 1)
        while True:
            total += math.comb(n + 1, m) * hit**m * (whole - hit) ** (n + 1 - m)
            if total / most >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def _verifier(similarity: tuple[int, int], miss: float):
    steps = least_matches(BANDS * BAND_SIZE, BATCH, similarity, miss)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_bytes_of(batch.column(c), BANDS * BAND_SIZE) for c in ("sa", "sb"))
            left, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
            for n, least in steps:
                matches = matches + (a[left, done:n] == b[left, done:n]).sum(axis=1)
                keep = matches >= least
                left, matches, done = left[keep], matches[keep], n
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(left)), batch.column("b").take(pa.array(left)), pa.array(matches)], names=["a", "b", "matches"])

    return verified


def _sizes_fit(similarity: tuple[int, int]) -> Column:
    return similarity[0] * F.greatest("na", "nb") <= similarity[1] * F.least("na", "nb")


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The top bit of each byte of the signatures, as longs."""
    for batch in batches:
        found = np.packbits(_bytes_of(batch.column("signature"), BANDS * BAND_SIZE) >> 7, axis=1).view(np.int64)
        names = [f"bits{i}" for i in range(found.shape[1])]
        columns = [pa.array(np.ascontiguousarray(c)) for c in found.T]
        yield pa.RecordBatch.from_arrays([batch.column("r"), batch.column("c"), batch.column("n"), *columns], names=["r", "c", "n", *names])


def _bits_fit(similarity: tuple[int, int], miss: float) -> Column:
    """The posterior bound on one bit of each place: bits agree with the probability (1 + s) / 2."""
    size = BANDS * BAND_SIZE
    least = least_matches(size, size, (similarity[0] + similarity[1], 2 * similarity[1]), miss)[0][1]
    differing = [F.bit_count(F.col(f"bits{i}a").bitwiseXOR(F.col(f"bits{i}b"))) for i in range(size // 64)]
    return sum(differing[1:], differing[0]) <= size - least


def _likely(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int], miss: float) -> DataFrame:
    """(a, b, matches) of pairs (a, b) that the signatures don't rule out."""
    one = sets.select(F.col("r").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    two = sets.select(F.col("r").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    met = pairs.select("a", "b").join(two, "b").join(one, "a").where(_sizes_fit(similarity))
    return met.select("a", "b", "sa", "sb").mapInArrow(_verifier(similarity, miss), "a long, b long, matches long")


def _gramming(shingle: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            text, hashes = _sets(batch.column("text"), shingle)
            ends = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=batch.num_rows)))).astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("r"), grams], names=["r", "grams"])

    return made


def _links(pairs: DataFrame, grams: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs whose whole sets are similar."""
    one = grams.select(F.col("r").alias("a"), F.col("grams").alias("ga"))
    two = grams.select(F.col("r").alias("b"), F.col("grams").alias("gb"))
    met = pairs.select("a", "b").join(two, "b").join(one, "a").withColumn("overlap", F.size(F.array_intersect("ga", "gb")))
    union = F.size("ga") + F.size("gb") - F.col("overlap")
    return met.where(similarity[1] * F.col("overlap") >= similarity[0] * union).select("a", "b")


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different components."""
    a, b = (labels.select(F.col("r").alias(x), F.col("c").alias(f"c{x}")) for x in "ab")
    met = pairs.join(a, "a", "left").join(b, "b", "left")
    return met.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb")


def _labelled(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(r, c): components of the links, joined to those before."""
    known = links if labels is None else links.union(labels.where("r <> c"))
    return stored(components(known).select(F.col("node").alias("r"), F.col("component").alias("c")), "minhash-labels")


def _central(entries: DataFrame) -> DataFrame:
    """(a, b): each set with the one of its bucket that lies in most buckets."""
    degree = entries.groupBy("r").agg(F.count("*").alias("degree"))
    ranked = stored(entries.join(degree, "r"), "minhash-ranked")
    centre = ranked.groupBy("band").agg(F.max(F.struct("degree", F.col("r").alias("a"))).alias("m")).select("band", "m.a")
    return ranked.join(centre, "band").where("a <> r").select("a", F.col("r").alias("b")).distinct()


def _open(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, size, r, c): entries of buckets that hold several components."""
    named = entries.join(labels, "r", "left").withColumn("c", F.coalesce("c", "r"))
    buckets = named.groupBy("band").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.count("*").alias("size"))
    return named.join(buckets.where("x <> y").select("band", "size"), "band")


def _members(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """(r, c, n, bits0, ...) of the sets in these entries."""
    held = entries.select("r", "c").distinct().join(sets.select("r", "n", "signature"), "r")
    longs = ", ".join(f"bits{i} long" for i in range(BANDS * BAND_SIZE // 64))
    return held.select("r", "c", "n", "signature").mapInArrow(_bits, f"r long, c long, n long, {longs}")


def _paired(entries: DataFrame, key: str, similarity: tuple[int, int], miss: float) -> DataFrame:
    """Pairs across components of entries (key, place, r, c, n, bits...) that share a key and may be
    linked by their sizes, places and bits.

    ``place`` counts the shingles of a set before the key, in one order of all shingles. If the key is
    the first that two sets share, they can share no more than what either has from there on. A pair
    that is linked passes at its first shared key, so others may fail.
    """
    one, two = (entries.select(key, *(F.col(x).alias(f"{x}{side}") for x in entries.columns if x != key)) for side in "ab")
    left = F.least(F.col("na") - F.col("placea"), F.col("nb") - F.col("placeb"))
    fits = (similarity[0] + similarity[1]) * left >= similarity[0] * (F.col("na") + F.col("nb"))
    met = (F.col("ra") < F.col("rb")) & (F.col("ca") != F.col("cb")) & _sizes_fit(similarity) & fits & _bits_fit(similarity, miss)
    return one.join(two, key).where(met).select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()


def _rare_pairs(members: DataFrame, grams: DataFrame, similarity: tuple[int, int], miss: float) -> DataFrame:
    """Pairs across components, of members, that share one of the rarest shingles: linked sets must
    share one of the first ``n - ceil(t * n) + 1`` of either, in one order."""
    held = stored(grams.select("r", F.explode("grams").alias("gram")), "minhash-rest")
    frequent = held.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    # Shingles of one set alone come first in the order, and are not needed to keep it.
    order = F.sort_array(F.collect_list(F.struct("df", "gram")))
    ordered = held.join(frequent, "gram").groupBy("r").agg(order.alias("grams")).join(members, "r")
    alone = F.col("n") - F.size("grams")
    lead = F.col("n") - F.ceil(similarity[0] * F.col("n") / similarity[1]) + 1 - alone
    first = F.slice("grams", F.lit(1), F.greatest(lead, F.lit(0)).cast("int"))
    keyed = ordered.select(F.posexplode(first.getField("gram")).alias("at", "gram"), alone.alias("alone"), *members.columns)
    return _paired(keyed.withColumn("place", F.col("alone") + F.col("at")).drop("alone", "at"), "gram", similarity, miss)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    similarity: tuple[int, int] = SIMILARITY,
    miss: float = MISS,
    paired: int = PAIRED,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row: its class under links of similar sets.

    Words are runs of other characters than ASCII spaces, A-Z lower-cased. A set holds the distinct
    shingles of ``shingle`` words, or the whole sequence if there are fewer; without words (null or
    empty text) it is empty and linked with nothing, and the row is its own class. Rows that repeat
    an id are rows of their own. A class is named by its smallest id that is not null, by null if it
    has none; rows that bear the name are kept, so rows of a repeated id are kept together. Texts of
    any length are read whole. An empty table gives an empty result. Columns besides id and text
    aren't read. A link is missed with a probability under 2e-8 (buckets 4e-9, twelve looks at the
    posterior ``miss`` each), which the probability of a link through other rows lowers further.
    """
    keys = [F.xxhash64(F.col(text_column)).alias("t1"), F.xxhash64(F.lit(1), F.col(text_column), F.length(text_column)).alias("t2")]
    texts = docs.select(F.col(id_column).cast("long").alias("row_id"), F.col(text_column).cast("string").alias("text"), *keys)
    rows = stored(texts.mapInArrow(_signer(shingle), _ROWS), "minhash-rows")
    # Equal sets are one from here on, numbered once and for all.
    sets = rows.where("n > 0").groupBy("c1", "c2").agg(
        F.any_value("n").alias("n"), F.any_value("signature").alias("signature"), F.min(F.struct("t1", "t2")).alias("t"), F.min("row_id").alias("least")
    )
    sets = stored(sets.select(F.monotonically_increasing_id().alias("r"), "c1", "c2", "n", "signature", "t.t1", "t.t2", "least"), "minhash-sets")
    banded = sets.select("r", "signature").mapInArrow(_banded, "band long, r long")
    entries = stored(banded.repartitionByRange("band", "r").sortWithinPartitions("band", "r").mapInArrow(_shared, "band long, r long"), "minhash-shared")
    likely = stored(_likely(_central(entries), sets, similarity, miss), "minhash-likely")
    # Whole sets only of those that are left somewhere.
    grams = _whole_sets(texts, sets, likely, shingle)
    best = likely.groupBy("b").agg(F.max(F.struct("matches", "a")).alias("m")).select("m.a", "b")
    labels = _labelled(stored(_links(best, grams, similarity), "minhash-best"), None)
    more = stored(_links(_across(likely, labels), grams, similarity), "minhash-more")
    if not more.isEmpty():
        labels = _labelled(more, labels)
    still = stored(_open(entries, labels), "minhash-open")
    members = stored(_members(still, sets), "minhash-members")
    pairs = _paired(still.where(F.col("size") <= paired).select("band", F.lit(0).alias("place"), "r").join(members, "r"), "band", similarity, miss)
    rest = stored(members.join(still.where(F.col("size") > paired), "r", "left_semi"), "minhash-large")
    if not rest.isEmpty():
        held = _whole_sets(texts, sets, rest.select(F.col("r").alias("a"), F.col("r").alias("b")), shingle)
        pairs = pairs.union(_rare_pairs(rest, held, similarity, miss)).distinct()
    likely = stored(_likely(pairs, sets, similarity, miss), "minhash-across")
    if not likely.isEmpty():
        last = stored(_links(likely, _whole_sets(texts, sets, likely, shingle), similarity), "minhash-last")
        if not last.isEmpty():
            labels = _labelled(last, labels)
    named = sets.select("r", "c1", "c2", "least").join(labels, "r", "left").withColumn("c", F.coalesce("c", "r"))
    # Written, so that the join below can split a large component.
    tops = stored(named.groupBy("c").agg(F.min("least").alias("component_id")), "minhash-names")
    classes = named.join(tops, "c").select("c1", "c2", "component_id")
    component = F.when(F.col("n") == 0, F.col("row_id")).otherwise(F.col("component_id"))
    joined = rows.select("row_id", "n", "c1", "c2").join(classes, ["c1", "c2"], "left").withColumn("component", component)
    return joined.select(
        F.col("row_id").alias(id_column), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("row_id").eqNullSafe(F.col("component")).alias("kept"),
    )


def _whole_sets(texts: DataFrame, sets: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """(r, grams) of the sets that the pairs (a, b) name, from one text of each."""
    wanted = pairs.select(F.col("a").alias("r")).union(pairs.select("b")).distinct()
    wanted = wanted.join(sets.select("r", "t1", "t2"), "r")
    found = texts.join(wanted, ["t1", "t2"]).groupBy("r").agg(F.min("text").alias("text"))
    return stored(found.mapInArrow(_gramming(shingle), "r long, grams array<long>"), "minhash-grams")
