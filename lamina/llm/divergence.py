"""Where sources of one language differ: distances between sources, and the terms that set one apart.

Terms are counted per group (language and source) inside the tasks that read the texts. A language keeps the
terms that enough of its documents have; a group gives each kept term the share
``1 + floor(10^9 * (count + 1) / (N + V))`` of its tokens, in whole numbers throughout.

The terms of a group are found by a dominance skyband. A term's value rises with its count in the group
and falls with its count in the language, and ties go to the earlier term; so a term is dominated by
each that has no smaller group count, no larger language count and comes earlier in UTF-8 (or is
like it in one of these), and whatever k others dominate is not among the first k. Every
partition keeps the terms of its part that fewer than k others there dominate, the skybands of
partitions are merged by skybands of skybands, and what is left is ranked exactly.

The distances between sources need every kept term, also where one source lacks it. Terms are dealt to
buckets, each bucket gets the list of groups as rows, and sums its terms for all pairs of sources in
numpy: a term costs the sources that have it times all sources, and no pair of sources is emitted for a term.

Null text, lang and source are empty strings. A group without terms, or of a language that keeps
none, has its rows of part ``pair``; an empty table gives an empty result. Each row of the input is a
document, whatever its id, so repeated rows count each time; extra columns are not read whatever
their names. A text of any length is counted whole.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import Staging

LEAST_DOCUMENTS, TOP_TERMS = 3, 200
#: Counted terms a task holds before it passes them on.
HELD_TERMS = 500_000
#: Rows of the term table to a bucket; each bucket reports a sum for every pair of sources it adds to.
BUCKET_ROWS = 100_000
#: Cells (terms by sources) of one numpy step, rows a group may wait for its skyband, terms of a step there.
CELLS, WAITING, STEP = 1 << 18, 4096, 256
#: Over how many tasks the skybands of one group are merged at first.
MERGERS = 16


def _term_bytes() -> bytes:
    """Lower case for A-Z, itself for a-z and all bytes of characters beyond ASCII, else a space."""
    kept = [b if b >= 0x80 or bytes([b]).isalpha() else 0x20 for b in range(256)]
    return bytes(kept).lower()


TERM_BYTES = _term_bytes()
COUNTED = "lang string, source string, term string, n long, df long"


def count_terms(batches):
    """Occurrences of each group's terms and the documents that have them, in one row per term
    as long as the task can hold them; and a row without a term for each group."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out():
        columns = [[], [], [], [], []]
        for (lang, source), (n, df) in counts.items():
            rows = len(n) + 1
            for column, values in zip(
                columns,
                ([lang] * rows, [source] * rows, [None, *n], [0, *n.values()], [0, *map(df.__getitem__, n)]),
            ):
                column.extend(values)
        counts.clear()
        terms = pa.array(columns[2], pa.binary()).cast(pa.string())
        numbers = [pa.array(c, pa.int64()) for c in columns[3:]]
        names = [pa.array(c, pa.string()) for c in columns[:2]]
        return pa.RecordBatch.from_arrays(
            [*names, terms, *numbers], names=["lang", "source", "term", "n", "df"]
        )

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            found = counts.get((lang, source))
            if found is None:
                found = counts[lang, source] = Counter(), Counter()
            terms = text.encode().translate(TERM_BYTES).split()
            before = len(found[0])
            found[0].update(terms)
            found[1].update(set(terms))
            held += len(found[0]) - before
            if held >= HELD_TERMS:
                yield out()
                held = 0
    if counts:
        yield out()


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / total) for count < total, by long division three digits
    at a time, so that no product leaves 64 bits."""
    rest, digits = count + 1, F.lit(0).cast("long")
    digits, rest = _div(rest, total), rest % total
    for _ in range(3):
        rest = rest * 1000
        digits, rest = digits * 1000 + _div(rest, total), rest % total
    return digits + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def term_table(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, term, source, n, lang_n, leads for the kept terms of each language, and a row with a
    null term for each group. ``leads`` marks one row of each term."""
    read = docs.select(
        *[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    )
    # everything up to the filter needs the rows of a term together: one shuffle, of counts
    counted = read.mapInArrow(count_terms, COUNTED).repartition("lang", "term")
    summed = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    term = Window.partitionBy("lang", "term")
    return (
        summed.withColumn("lang_n", F.sum("n").over(term))
        .withColumn("lang_df", F.sum("df").over(term))
        .withColumn("leads", F.row_number().over(term.orderBy("source")) == 1)
        .where((F.col("lang_df") >= least) | F.col("term").isNull())
        .select("lang", "term", "source", "n", "lang_n", "leads")
    )


def group_sizes(table: DataFrame) -> DataFrame:
    """lang, source, total (N + V), lang_total, kept (V) for every group."""
    terms = table.where(F.col("term").isNotNull())
    groups = table.where(F.col("term").isNull()).select("lang", "source")
    sums = terms.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = terms.groupBy("lang").agg(
        F.sum("n").alias("lang_n"), F.sum(F.col("leads").cast("long")).alias("kept")
    )
    zero = F.lit(0).cast("long")
    return (
        groups.join(sums, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["n", "lang_n", "kept"])
        .select(
            "lang", "source",
            (F.col("n") + F.col("kept")).alias("total"),
            (F.col("lang_n") + F.col("kept")).alias("lang_total"),
            F.coalesce("kept", zero).alias("kept"),
        )
    )


# ---- pairs of sources -----------------------------------------------------


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class PairSums:
    """Sums over the terms of one bucket and language, for all pairs of its sources."""

    def __init__(self, sources: list[str], lacking: list[int]):
        self.place = {s: i for i, s in enumerate(sources)}
        self.lacking = np.array(lacking, np.int64)  # the share of a term that a source lacks
        self.base = excess(self.lacking[:, None], self.lacking)
        self.total = np.zeros((len(sources), len(sources)), np.int64)
        self.rows: list[tuple[int, int, int]] = []
        self.terms = 0

    def add(self, term: list[tuple[str, int]]) -> None:
        place = self.place
        self.rows.extend((self.terms, place[source], p) for source, p in term)
        self.terms += 1
        if max(self.terms, len(self.rows)) * len(place) >= CELLS:
            self.sum_up()

    def sum_up(self) -> None:
        """f(p, q) of the waiting terms: rows as the group, rows as the other where the group
        lacks the term, and the base value where both do."""
        if not self.terms:
            return
        at, source, p = np.array(self.rows, np.int64).T
        shares = np.tile(self.lacking, (self.terms, 1))
        shares[at, source] = p
        has = np.zeros(shares.shape, bool)
        has[at, source] = True
        order = np.argsort(source, kind="stable")
        at, source, p = at[order], source[order], p[order]
        starts = np.flatnonzero(np.concatenate([[True], source[1:] != source[:-1]]))
        present = source[starts]
        as_group = np.add.reduceat(excess(p[:, None], shares[at]), starts, axis=0)
        as_other = np.add.reduceat(
            np.where(has[at], 0, excess(self.lacking, p[:, None])), starts, axis=0
        )
        alone = np.add.reduceat((~has[at]).astype(np.int64), starts, axis=0)
        both = np.full(self.total.shape, self.terms, np.int64)
        both[present] -= np.bincount(source, minlength=len(self.lacking))[present][:, None]
        both[:, present] -= alone.T
        self.total += both * self.base
        self.total[present] += as_group
        self.total[:, present] += as_other.T
        self.rows, self.terms = [], 0


PAIRS = "lang string, source string, item string, value long"


def pair_sums(batches):
    """Rows by bucket, language and term, a language's groups (null terms) first; pairs of
    sources with the sums over this task's terms. Bucket 0 reports every pair, others what they add."""

    def out(lang, sums, bucket):
        sums.sum_up()
        wanted = np.ones(sums.total.shape, bool) if bucket == 0 else sums.total != 0
        np.fill_diagonal(wanted, False)
        group, other = np.nonzero(wanted)
        names = np.array([*sums.place, ""], object)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(group), pa.string()),
                pa.array(names[group].tolist(), pa.string()),
                pa.array(names[other].tolist(), pa.string()),
                pa.array(sums.total[group, other], pa.int64()),
            ],
            names=["lang", "source", "item", "value"],
        )

    now = sums = term = None
    groups: list[tuple[str, int]] = []
    rows: list[tuple[str, int]] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "lang", "term", "source", "p")]
        for bucket, lang, name, source, p in zip(*columns):
            if (bucket, lang) != now or name != term:
                if term is not None:
                    sums.add(rows)
                if (bucket, lang) != now:
                    if now is not None:
                        yield out(now[1], sums or PairSums(*zip(*groups)), now[0])
                    now, sums, groups = (bucket, lang), None, []
                elif sums is None:
                    sums = PairSums(*zip(*groups))
                term, rows = name, []
            (groups if name is None else rows).append((source, p))
    if term is not None:
        sums.add(rows)
    if now is not None:
        yield out(now[1], sums or PairSums(*zip(*groups)), now[0])


def source_pairs(shares: DataFrame, sizes: DataFrame, buckets: int) -> DataFrame:
    """lang, source, item (another source), value for all pairs of sources of a language."""
    bucket = F.pmod(F.xxhash64("lang", "term"), F.lit(buckets)).cast("int")
    body = shares.select(bucket.alias("bucket"), "lang", "term", "source", "p")
    # a language that keeps no term has a total of 0 and no use for shares: all its sums are 0
    lacking = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"))).otherwise(1)
    heads = sizes.select(
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
        "lang", F.lit(None).cast("string").alias("term"), "source", lacking.cast("long").alias("p"),
    )
    dealt = heads.unionByName(body).repartition(buckets, "bucket")
    ordered = dealt.sortWithinPartitions("bucket", "lang", F.col("term").asc_nulls_first(), "source")
    return ordered.mapInArrow(pair_sums, PAIRS).groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value")
    )


# ---- terms of a source ----------------------------------------------------


def skyband(n: np.ndarray, lang_n: np.ndarray, terms: list[str], k: int) -> np.ndarray:
    """Places of the rows that fewer than ``k`` others dominate.

    In order of falling ``n``, then ``lang_n`` and term, nothing is dominated by what comes after
    it; and what k rows dominate, k rows of the skyband do, so only those are compared with.
    """
    by_term = np.argsort(np.array(terms, object), kind="stable")
    rank = np.empty(len(by_term), np.int64)
    rank[by_term] = np.arange(len(by_term))
    order = np.lexsort((rank, lang_n, -n))
    a, b = n[order], lang_n[order]
    # of rows alike in both counts the first k
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    order = order[np.arange(len(order)) - start < k]
    kept = np.empty(0, np.int64)
    for at in range(0, len(order), STEP):
        step = order[at : at + STEP]
        above = _dominators(lang_n, rank, kept, step).sum(axis=1)
        inner = np.tril(_dominators(lang_n, rank, step, step), -1).sum(axis=1)
        kept = np.concatenate([kept, step[above + inner < k]])
    return kept


def _dominators(lang_n, rank, earlier, rows) -> np.ndarray:
    fewer = lang_n[earlier] <= lang_n[rows][:, None]
    return fewer & (rank[earlier] <= rank[rows][:, None])


TERMS = "lang string, source string, term string, n long, lang_n long"


def skybands(k: int):
    """A function over batches of ``TERMS`` that keeps each group's skyband within the task."""

    def run(batches):
        waiting: dict[tuple[str, str], list] = {}
        names = [part.split()[0] for part in TERMS.split(", ")]

        def reduce(rows: list) -> list:
            terms, n, lang_n = zip(*rows)
            left = skyband(np.array(n, np.int64), np.array(lang_n, np.int64), list(terms), k)
            return [rows[i] for i in left.tolist()]

        limit: dict[tuple[str, str], int] = {}
        for batch in batches:
            langs, sources, *rest = (batch.column(c).to_pylist() for c in names)
            for key, row in zip(zip(langs, sources), zip(*rest)):
                rows = waiting.get(key)
                if rows is None:
                    rows = waiting[key] = []
                rows.append(row)
                if len(rows) >= limit.get(key, WAITING):
                    waiting[key] = reduce(rows)
                    limit[key] = WAITING + 2 * len(waiting[key])
        for (lang, source), rows in waiting.items():
            rows = reduce(rows)
            terms, n, lang_n = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(rows), pa.string()),
                    pa.array([source] * len(rows), pa.string()),
                    pa.array(terms, pa.string()),
                    pa.array(n, pa.int64()),
                    pa.array(lang_n, pa.int64()),
                ],
                names=names,
            )

    return run


def source_terms(shares: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """lang, source, item (a term that the source has more than its share of), value: for each
    group at least its first ``k``."""
    over = shares.where(F.col("p") > F.col("q")).select("lang", "source", "term", "n", "lang_n")
    near = over.mapInArrow(skybands(k), TERMS)
    part = F.pmod(F.xxhash64("term"), F.lit(MERGERS))
    merged = near.repartition(F.col("lang"), F.col("source"), part).mapInArrow(skybands(k), TERMS)
    return with_shares(merged, sizes).select(
        "lang", "source", F.col("term").alias("item"),
        _div((F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q")).alias("value"),
    )


def with_shares(terms: DataFrame, sizes: DataFrame) -> DataFrame:
    """p, the group's share of the term, and q, the language's."""
    found = terms.join(sizes, ["lang", "source"])
    return found.withColumn("p", share(F.col("n"), F.col("total"))).withColumn(
        "q", share(F.col("lang_n"), F.col("lang_total"))
    )


def audit(
    docs: DataFrame, staging: Staging, *, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS
) -> DataFrame:
    """lang, source, part, item, value, rank: other sources by distance (part ``pair``), and a
    source's first ``top`` terms (part ``term``)."""
    table = staging.write(term_table(docs, least), "terms")
    # written, so that its size decides how it is joined: one row for each group
    sizes = staging.write(group_sizes(table), "groups")
    shares = with_shares(table.where(F.col("term").isNotNull()), sizes)
    buckets = max(2, table.count() // BUCKET_ROWS + 1)
    pairs = source_pairs(shares, sizes, buckets).withColumn("part", F.lit("pair"))
    terms = source_terms(shares, sizes, top).withColumn("part", F.lit("term"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    rank = F.row_number().over(ranked).cast("int").alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    first = terms.select(*columns, rank).where(F.col("rank") <= top)
    return pairs.select(*columns, rank).unionByName(first)
