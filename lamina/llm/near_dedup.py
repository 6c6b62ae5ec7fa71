"""Near-duplicate groups by SuperMinHash signatures.

For every element SuperMinHash draws a random permutation of the signature's slots and gives
the slot at rank r the value r plus a random fraction; a slot keeps its least value. The
ranks of one element are all different, which spreads its values over the slots and makes the
estimate vary less than independent hashes do. Ranks are drawn lowest first and drawing stops
once no slot can get lower.

Documents with the same shingle set are one from the start. The signature is cut into bands;
sets that share a band meet in a bucket, and each bucket's members are tried against one of
them, its centre. Tried pairs are links if the whole sets confirm it. Components of the links are
found by union-find in rounds of large and small stars. The members that one centre brings together and
that are still in several components are then told apart by what they do not share with the centre: with d(x) the
shingles that only one of x and the centre has, the union of x and y less their intersection has
d(x) + d(y) - 2 * (what both differences share) elements, so a link across components needs
differences that share enough. Shingles of differences are ordered, those many members have
last, and a pair is made only if it shares one with enough others behind it. A member's difference
also has a few words of bits, by place in the centre's set for what it lacks of it and by hash for what it has beside it:
each bit that one has and the other has not is an element they do not share. Pairs ruled out by that are not made either,
and a pair that has a rarer shingle in common, among the most common ones around its centre, is left to that one. What
a bucket brings together is decided for every pair that could still change a component, with no cap on
a bucket; pairs inside a component, and pairs that are alike only in what their centre has too, are not made.

Null and empty texts have no shingles and are linked with nothing; they are their own
component. Rows that repeat a doc_id are one document: the union of their shingles would
be no text's, so the row with the smallest set digest speaks for them. Null doc_ids form
no links and are returned as their own component (null). Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import release_shuffles, slices, texts_of
from lamina.llm.packing import mix
from lamina.llm.shingles import Shingler
from lamina.llm.units import of_worker
from lamina.session import Staging

SLOTS = 128
#: Bits that tell which rows may be in a bucket with others.
MARKS = 1 << 25
PERCENT = 75
#: Of pairs just similar enough, so many may share no band, or differ in too many bits.
NO_BAND, TOO_MANY_BITS = 1e-5, 1e-7
#: Words of 64 bits that bound from above what two differences share, for what the centre has
#: alone (its number is n_lost) and what the member has alone (n_own).
WORDS = {"n_lost": ["l0", "l1", "l2"], "n_own": ["o0", "o1"]}
BOUNDS = [column for n, words in WORDS.items() for column in (n, *words)]
#: Words with a bit for each rarer shingle of the difference, of the most common ones around a centre.
FRONT = ["f0", "f1", "f2"]
#: Hash values of a set that are drawn for at once.
AT_ONCE = 1 << 15


def super_minhash(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """The signature of a set of 64-bit hashes: per slot the least value, rank in the high
    32 bits, fraction in the low ones. Long sets are taken in parts; least values combine."""
    best = np.full(slots, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(elements), AT_ONCE):
        part = elements[at : at + AT_ONCE]
        n = len(part)
        places = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (n, 1))
        row = np.arange(n)
        for rank in range(slots):
            if best.max() >> np.uint64(32) < rank:
                break  # every slot holds a lower rank: no draw from here on can win
            drawn = mix(part + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            other = rank + ((drawn >> np.uint64(32)) * np.uint64(slots - rank) >> np.uint64(32))
            other = other.astype(np.intp)
            slot = places[row, other]
            places[row, other] = places[:, rank]
            value = np.uint64(rank) << np.uint64(32) | drawn & np.uint64(0xFFFFFFFF)
            np.minimum.at(best, slot, value)
    return best


def band_rows(percent: int) -> int:
    """Slots of a band: the most that leave a pair of this similarity a shared band."""
    for rows in (16, 8, 4, 2, 1):
        if (1 - (percent / 100) ** rows) ** (SLOTS // rows) <= NO_BAND:
            return rows
    raise ValueError(f"{SLOTS} slots cannot find pairs of {percent} percent.")


def most_bits(percent: int) -> int:
    """Bits in which sketches of a pair of this similarity differ at most: a slot that is not
    alike, of which there are 1 - similarity, has another bit half of the time."""
    differ, beyond = (1 - percent / 100) / 2, 1.0
    for bits in range(SLOTS):
        beyond -= math.comb(SLOTS, bits) * differ**bits * (1 - differ) ** (SLOTS - bits)
        if beyond <= TOO_MANY_BITS:
            return bits
    return SLOTS


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    keys = np.zeros(len(signature) // rows, np.uint64)
    for i in range(rows):
        keys = mix(keys * np.uint64(31) + signature[i::rows][: len(keys)])
    return keys


def signatures(docs: DataFrame, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the set), bands (keys, 8 bytes each) and sketch
    (one bit of each slot, as two longs)."""

    def run(batches):
        shingler = of_worker(Shingler)
        for batch in slices(batches, 500):
            n, keys, bands, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                own = shingler.shingles(text)
                n.append(len(own))
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                signature = super_minhash(own)
                bands.append(band_keys(signature, rows).tobytes() if len(own) else b"")
                bits = np.packbits((mix(signature) & np.uint64(1)).astype(np.uint8))
                sketches.append(bits.view(np.int64))
            sketches = np.array(sketches).reshape(-1, SLOTS // 64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.binary()), *map(pa.array, sketches.T.copy())],
                names=["doc_id", "n_shingles", "set_key", "bands", "s0", "s1"],
            )

    return texts_of(docs).mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, bands binary, s0 long, s1 long"
    )


def buckets(reps: DataFrame, rows: int) -> DataFrame:
    """doc_id and bucket (band number and key as one hash) for each band of each set."""
    bands = SLOTS // rows

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            keys = [np.frombuffer(b, np.uint64) for b in batch.column("bands").to_pylist()]
            if not len(ids):
                continue
            own = mix(np.stack(keys) ^ mix(np.arange(1, bands + 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, bands)), pa.array(own.ravel().view(np.int64))],
                names=["doc_id", "bucket"],
            )

    return reps.select("doc_id", "bands").mapInArrow(run, "doc_id long, bucket long")


def marked(ids: DataFrame) -> np.ndarray:
    """A bit for the hash of each of ``ids`` (column at), in 64-bit words: at most ``MARKS`` bits
    come to the driver, however many ids there are."""
    word = ids.groupBy(F.shiftright("at", 6).alias("word"))
    found = word.agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")).toArrow()
    bits = np.zeros(MARKS >> 6, np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits.view(np.uint64)


def shingle_sets(docs: DataFrame, ids: DataFrame, staging: Staging) -> DataFrame:
    """doc_id and set (sorted hashes) of the rows of ``docs`` with one of ``ids``, written once.

    Only sets of marked rows are made and shuffled, which are these and few others; the
    join then leaves the others out.
    """
    at = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    bits = docs.sparkSession.sparkContext.broadcast(marked(ids.select(at.alias("at"))))

    def run(batches):
        shingler = of_worker(Shingler)
        for batch in slices(batches, 500):
            place = batch.column("at").to_numpy()
            mine = bits.value[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)
            batch = batch.filter(pa.array(mine.astype(bool)))
            sets = [shingler.shingles(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "set"]
            )

    texts = texts_of(docs).where("doc_id IS NOT NULL").withColumn("at", at)
    sets = texts.mapInArrow(run, "doc_id long, set binary")
    return staging.write(sets.join(ids, "doc_id", "left_semi"), "near-sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are similar enough."""

    def check(batches):
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                small, large = min(len(x), len(y)), max(len(x), len(y))
                if 100 * small < percent * large:
                    kept.append(False)
                    continue
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                kept.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    joined = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a")), "a")
    joined = joined.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b")), "b")
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(check, "a long, b long")


def bounds(lost: np.ndarray, own: np.ndarray) -> list[int]:
    """The values of ``BOUNDS`` for places that a member lacks and hashes it has beside the centre's."""
    out: list[int] = []
    for part, words in zip((lost, mix(own)), WORDS.values()):
        bits = np.zeros(64 * len(words), np.uint8)
        bits[(part % part.dtype.type(len(bits))).astype(np.intp)] = 1
        out += [len(part), *np.packbits(bits).view(np.int64).tolist()]
    return out


def differing(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``members`` (centre, doc_id, component) with rest, the hashes that only one of
    document and centre has, ``BOUNDS`` of these, and weight: x and y are linked if their rests share
    at least (weight of x + weight of y) / (2 * (100 + percent)) hashes."""

    def run(batches):
        for batch in batches:
            rests, weights, bound = [], [], []
            for own, of in zip(batch.column("set").to_pylist(), batch.column("of_centre").to_pylist()):
                own, of = np.frombuffer(own, np.uint64), np.frombuffer(of, np.uint64)
                rest = np.setxor1d(own, of, assume_unique=True)
                rests.append(rest.tobytes())
                place = np.searchsorted(of, rest)
                place[of[np.minimum(place, len(of) - 1)] != rest] = -1
                bound.append(bounds(place[place >= 0], rest[place < 0]))
                weights.append((100 + percent) * len(rest) - (100 - percent) * len(own))
            columns = [batch.column(c) for c in ("centre", "doc_id", "component")]
            bound = np.array(bound, np.int64).reshape(-1, len(BOUNDS))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(weights, pa.int64()), pa.array(rests, pa.binary()),
                 *map(pa.array, bound.T.copy())],
                names=["centre", "doc_id", "component", "weight", "rest", *BOUNDS],
            )

    # Rows that repeat an id have several sets; one of them is the centre all are held against.
    centres = members.select(F.col("centre").alias("doc_id")).distinct()
    of_centre = sets.join(centres, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("set").alias("of_centre"))
    joined = members.join(sets, "doc_id").join(of_centre.withColumnRenamed("doc_id", "centre"), "centre")
    return joined.select("centre", "doc_id", "component", "set", "of_centre").mapInArrow(
        run,
        "centre long, doc_id long, component long, weight long, rest binary, "
        + ", ".join(f"{c} long" for c in BOUNDS),
    )


def partners(members: DataFrame) -> DataFrame:
    """``members`` with partner: the least weight around their centre in another component."""
    each = members.groupBy("centre", "component").agg(F.min("weight").alias("weight"))
    least = each.groupBy("centre").agg(F.min(F.struct("weight", "component")).alias("first"))
    second = each.join(least, "centre").where("component <> first.component")
    second = second.groupBy("centre").agg(F.min("weight").alias("second"))
    return members.join(least.join(second, "centre"), "centre").select(
        *members.columns,
        F.when(F.col("component") == F.col("first.component"), F.col("second"))
        .otherwise(F.col("first.weight"))
        .alias("partner"),
    )


def hashes_of(members: DataFrame) -> DataFrame:
    """A row for each hash in the rests of ``members``."""
    names = ["centre", "member", "doc_id", "component", "weight", "partner"]

    def run(batches):
        for batch in slices(batches, 500):
            rests = batch.column("rest").to_pylist()
            at = pa.array(np.repeat(np.arange(len(rests)), [len(r) // 8 for r in rests]))
            hashes = np.frombuffer(b"".join(rests), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in names), pa.array(hashes)], names=[*names, "hash"]
            )

    kinds = ", ".join(f"{c} long" for c in [*names, "hash"])
    return members.select(*names, "rest").mapInArrow(run, kinds)


def placed_hashes(hashes: DataFrame) -> DataFrame:
    """``hashes`` (centre, hash, n) with place: of the most common ones around a centre a number of its own."""
    each = hashes.groupBy("centre", "hash").agg(F.max("n").alias("n"))
    common = Window.partitionBy("centre").orderBy(F.desc("n"), "hash")
    top = each.withColumn("place", F.row_number().over(common) - 1).where(F.col("place") < 64 * len(FRONT))
    return hashes.join(top.select("centre", "hash", "place"), ["centre", "hash"], "left")


def front(order) -> list:
    """``FRONT`` of a row: the places of the rows before it in the window ``order``."""
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    columns = []
    for i, name in enumerate(FRONT):
        own = F.when(F.floor(F.col("place") / 64) == i, F.expr("shiftleft(1L, place & 63)")).otherwise(0)
        columns.append(F.coalesce(F.bit_or(own).over(before), F.lit(0)).alias(name))
    return columns


def open_pairs(tried: DataFrame, found: DataFrame, sets: DataFrame, percent: int, staging: Staging) -> DataFrame:
    """The pairs (a, b) across the components ``found`` that have a centre of ``tried`` (a: centre,
    b: member) in common and may be linked; the pairs left out are not."""
    of_member = (
        tried.select(F.col("a").alias("centre"), F.col("b").alias("doc_id"))
        .join(found, "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )
    split = of_member.groupBy("centre").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    members = staging.write(
        of_member.join(split.where("lo <> hi"), "centre", "left_semi").select("centre", "doc_id", "component"),
        "near-open",
    )
    members = differing(members, sets, percent).withColumn("member", F.monotonically_increasing_id())
    members = partners(staging.write(members, "near-differing"))
    twice = 2 * (100 + percent)
    members = members.where(F.octet_length("rest") / 8 * twice >= F.col("weight") + F.col("partner"))
    # Only hashes that several components have can be shared by a pair. A pair's first shared hash
    # has all others behind it, in the order of any of the two.
    having, behind = Window.partitionBy("centre", "hash"), Window.partitionBy("member")
    hashes = hashes_of(members).select(
        "*",
        F.count(F.lit(1)).over(having).alias("n"),
        F.min("component").over(having).alias("lo"),
        F.max("component").over(having).alias("hi"),
    )
    shared = (
        placed_hashes(hashes.where("lo <> hi"))
        .select(
            "*",
            F.row_number().over(behind.orderBy(F.desc("n"), "hash")).alias("left"),
            *front(behind.orderBy("n", F.desc("hash"))),
        )
        .where(F.col("left") * twice >= F.col("weight") + F.col("partner"))
    )
    # Bounds come by member, by which these rows lie already.
    shared = shared.select("centre", "hash", "member", "doc_id", "component", "weight", "left", *FRONT)
    shared = shared.join(members.select("member", *BOUNDS), "member").drop("member")
    shared = staging.write(shared, "near-shared")
    x, y = (
        shared.select("centre", "hash", *[F.col(c).alias(f"{d}_{c}") for c in shared.columns[2:]]) for d in "ab"
    )
    # What two differences share is at most what is behind, and at most what has its bit in both.
    most = f"least(a_left, b_left, {at_most()})"
    # A rarer hash that both have makes the pair already, with more behind it.
    first = " AND ".join(f"a_{w} & b_{w} = 0" for w in FRONT)
    enough = f"{most} * {twice} >= a_weight + b_weight"
    return (
        x.join(y, ["centre", "hash"])
        .where(f"a_doc_id < b_doc_id AND a_component <> b_component AND {first} AND {enough}")
        .select(F.col("a_doc_id").alias("a"), F.col("b_doc_id").alias("b"))
        .distinct()
    )


def at_most() -> str:
    """By ``BOUNDS`` of a and b, what their differences share at most."""

    def of(n, words, a, b):
        return " - ".join([f"{a}_{n}", *(f"bit_count({a}_{w} & ~{b}_{w})" for w in words)])

    parts = (f"least({of(n, words, 'a', 'b')}, {of(n, words, 'b', 'a')})" for n, words in WORDS.items())
    return " + ".join(parts)


def alike(pairs: DataFrame, sketches: DataFrame, limit: int) -> DataFrame:
    """The pairs whose sketches differ in at most ``limit`` bits."""
    for d in "ab":
        own = sketches.select(F.col("doc_id").alias(d), F.col("s0").alias(f"{d}0"), F.col("s1").alias(f"{d}1"))
        pairs = pairs.join(own, d)
    return pairs.where(f"bit_count(a0 ^ b0) + bit_count(a1 ^ b1) <= {limit}").select("a", "b")


SALTS = 16


def spread_join(many: DataFrame, one: DataFrame, key: str, by: str) -> DataFrame:
    """Inner join of ``many`` with one row per ``key``, a crowded key dealt over copies of it."""
    copies = one.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = many.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return salted.join(copies, [key, "salt"]).drop("salt")


def components(links: DataFrame, staging: Staging) -> DataFrame:
    """doc_id and component (smallest linked id) of every id in ``links`` (a, b).

    Union-find over tables: a large star hangs the larger neighbours of each id on the least
    id around it, a small star does so for the smaller ones; alternating, the trees flatten to stars.
    Each round is written, so no lineage grows.
    """
    edges = staging.write(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "near-links",
    )
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = spread_join(both, least.withColumn("m", F.least("u", "m")), "u", "v")
        large = large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staging.write(large.where("u <> v").distinct(), "near-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, least, "u", "v")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        edges = staging.write(small.where("u <> v").distinct(), "near-small")
        now = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if before == now:
            break
        before = now
    roots = edges.select(F.col("v").alias("doc_id")).distinct()
    return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component")).union(
        roots.select("doc_id", F.col("doc_id").alias("component"))
    )


def near_groups(
    docs: DataFrame, percent: int = PERCENT, staging: Staging | None = None
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    spark = docs.sparkSession
    staging = staging or Staging(spark)
    in_band, limit = band_rows(percent), most_bits(percent)
    rows = staging.write(signatures(docs, in_band), "near-signatures")
    with_id = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    first = with_id.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    # Members of one set, and rows of one id, are links of their own.
    same = staging.write(
        spread_join(with_id.select("set_key", "doc_id"), first, "set_key", "doc_id")
        .where("doc_id <> rep")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")),
        "near-same",
    )
    reps = with_id.join(
        first.select("set_key", F.col("rep").alias("doc_id")), ["set_key", "doc_id"], "left_semi"
    )
    reps = reps.groupBy("doc_id").agg(F.min(F.struct("set_key", "bands", "s0", "s1")).alias("x"))
    sketches = staging.write(reps.select("doc_id", "x.s0", "x.s1"), "near-sketches")
    placed = buckets(reps.select("doc_id", "x.bands"), in_band)
    least = placed.groupBy("bucket").agg(
        F.min("doc_id").alias("centre"), F.count(F.lit(1)).alias("n")
    )
    shared = least.where("n > 1").select("bucket", "centre")
    member = staging.write(spread_join(placed, shared, "bucket", "doc_id"), "near-buckets")
    tried = staging.write(
        member.where("doc_id <> centre")
        .select(F.col("centre").alias("a"), F.col("doc_id").alias("b"))
        .distinct(),
        "near-tried",
    )
    # Whatever is tried later is in a bucket too: its sets are made here, and texts not read again.
    in_bucket = staging.write(member.select("doc_id").distinct(), "near-members")
    sets = shingle_sets(docs, in_bucket, staging)
    links = staging.write(confirm(tried, sets, percent), "near-confirmed")
    release_shuffles(spark)
    found = staging.write(components(links.union(same), staging), "near-components")
    more = staging.write(
        alike(open_pairs(tried, found, sets, percent, staging), sketches, limit), "near-more"
    )
    new = staging.write(confirm(more, sets, percent), "near-confirmed")
    release_shuffles(spark)
    if not new.isEmpty():
        # No pair is left to try: what is in one component now was in one or in two before.
        found = staging.write(components(links.union(new).union(same), staging), "near-components")
    return rows.join(found, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, staging: Staging) -> DataFrame:
    """The rows of ``docs`` of one document per group, the one with the smallest id."""
    passing = Staging(docs.sparkSession)  # what only finding the groups needs
    groups = near_groups(docs, staging=passing)
    gone = staging.write(groups.where("not kept").select("doc_id").distinct(), "near-gone")
    passing.release()
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
