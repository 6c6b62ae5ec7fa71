"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids meet.

Both tokenizers write a text, with a space before it, as tokens that cover the same bytes. Where
tokens of both end at one byte the text can be cut. The cuts are found by divide and conquer:
in an interval the end of the first tokenizer nearest its middle that the second one shares (found by
bisection among the second one's ends) splits it, and both halves are treated alike; an
interval without such an end is a leaf, one group. All intervals at one depth are treated in one
numpy step. All tokens of a group are linked with each other.

Words come again, and both tokenizers cut before the space in front of one. So what is aligned are
the distinct words a worker has not met yet, all those of a batch laid end to end as one interval, and
each text is put together from its words' groups. A text in which one of the tokenizers may reach over
such a border (white space in a row) lies in the interval as a whole.

Links are counted over the corpus per pair of ids: a pair counts once a document. Each document's
distinct pairs are written once; the counts meet them again in two tiers, the most frequent pairs,
at most ``HOT_PAIRS``, as a broadcast table, the rest in a join by pair, in which no pair has many
rows. Both tiers are exact, the bound only decides which one serves a pair.

A text that is null or empty, or that either tokenizer does not give back byte for byte, has no tokens:
zeros, and an empty digest. A text is aligned whole, whatever its length (about 100 bytes of
arrays a token while its batch lasts). Rows are told apart by a tag, not by their id: repeated rows
and ids, null ids included, give a row each, and each counts as a document. Extra columns are not read
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import slices_by_size, texts_of
from lamina.llm.sentence_pieces import SPACE, PieceEncoder
from lamina.llm.units import IDS, JOINED, IdEncoder, Remembered, byte_alphabet, of_worker
from lamina.session import Staging

#: Units of a worker's caches, of one alignment, and texts and bytes of a batch.
MOST_UNITS, WHOLE_UNITS, UNITS_AT_ONCE = 1_200_000, 100_000, 50_000
BATCH_ROWS, BATCH_BYTES = 500, 2_000_000
#: Pairs of the broadcast table.
HOT_PAIRS = 1 << 19
#: Ends tried on each side of the middle one by one; further out an interval is searched whole.
NEAR = 32
#: Links of a group up to which each is written out before ids are counted.
WRITTEN_LINKS = 4096

ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<long>"
)


class PlainIds(IdEncoder):
    """Byte-level ids; the strings of special tokens inside a text are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.units.tokenizer.encode_special_tokens = True
        self.units.found = re.compile(r"(?!)")
        self.of_unit = Remembered(self.of_unit.make, WHOLE_UNITS)
        self.tokenize, self.space = self.units.tokenizer.model.tokenize, byte_alphabet()[32]

    def ids_of(self, literal: str) -> list[int]:
        """Ids of a unit, nothing remembered."""
        word = literal[1:]
        if literal[0] == " " and word.isascii() and word.isalpha():  # one pre-token, its own spelling
            return [t.id for t in self.tokenize(self.space + word)]
        return [t.id for piece in self.units.pieces(literal) for t in self.tokenize(piece)]

    def spellings(self) -> list[bytes]:
        """The bytes of each id."""
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        vocabulary = self.units.tokenizer.get_vocab(with_added_tokens=True)
        out = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in byte_of for c in token)
            out[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        return out


class PieceIds(PieceEncoder):
    """Ids by the sentencepiece library, asked once for each distinct unit."""

    def learn(self, keys: set[str]) -> dict[str, bytes]:
        found = self.by_library([self.literal(k) for k in keys])
        return {k: array("I", ids).tobytes() for k, ids in zip(keys, found)}


def shared_cuts(
    a: np.ndarray, b: np.ndarray, a_stops: np.ndarray, b_stops: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into ``a`` and ``b``, both sorted, of the ends they share.

    ``a_stops`` and ``b_stops`` say where each text's ends stop; the last end of a text is
    always shared. An interval is ``a[lo:hi]`` against ``b[low:high]``, its last ends being equal.
    """
    cut_a, cut_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    cut_a[a_stops - 1] = cut_b[b_stops - 1] = True
    lo, hi = np.concatenate([[0], a_stops[:-1]]), a_stops
    low, high = np.concatenate([[0], b_stops[:-1]]), b_stops
    while True:
        more = (hi - lo > 1) & (high - low > 1)
        if not more.any():
            return np.flatnonzero(cut_a), np.flatnonzero(cut_b)
        lo, hi, low, high = lo[more], hi[more], low[more], high[more]
        found, place = near_middle(a, b, lo, hi)
        split = found >= 0
        at, to = found[split], place[split]
        cut_a[at] = cut_b[to] = True
        lo, hi = np.concatenate([lo[split], at + 1]), np.concatenate([at + 1, hi[split]])
        low, high = np.concatenate([low[split], to + 1]), np.concatenate([to + 1, high[split]])


def near_middle(a, b, lo, hi) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the index in ``a`` of the shared inner end nearest its middle, and that
    end's index in ``b``; -1 where none is shared. The interval's own end does not count."""
    last = hi - 2
    middle = (lo + last) // 2
    found, place = np.full(len(lo), -1), np.full(len(lo), -1)
    left = np.arange(len(lo))
    for step in range(NEAR):
        for side in (step, -step) if step else (0,):
            c = middle[left] + side
            inside = (c >= lo[left]) & (c <= last[left])
            who, c = left[inside], c[inside]
            p = np.searchsorted(b, a[c])
            hit = b[p] == a[c]  # no end of ``a`` lies beyond the last one of ``b``
            found[who[hit]], place[who[hit]] = c[hit], p[hit]
            left = left[found[left] < 0]
        out = (middle[left] - step <= lo[left]) & (middle[left] + step >= last[left])
        left = left[~out]
        if not len(left):
            return found, place
    for i in left:
        c = np.arange(lo[i], last[i] + 1)
        p = np.searchsorted(b, a[c])
        hits = np.flatnonzero(b[p] == a[c])
        if len(hits):
            best = hits[np.argmin(np.abs(c[hits] - middle[i]))]
            found[i], place[i] = c[best], p[best]
    return found, place


#: A remembered unit is one string of bytes: numbers of its tokens on both sides, groups, links and
#: distinct pairs; the pairs; how many links each has, where that is not one each; its groups as text.
HEAD = np.dtype("<u4")
HEAD_BYTES = 5 * HEAD.itemsize
#: A unit that one of the tokenizers does not give back: its text has no tokens.
NO_TOKENS = 2**32 - 1
LOST = np.array([NO_TOKENS, 0, 0, 0, 0], HEAD).tobytes()


class Aligner:
    """Encodes texts with both tokenizers and aligns them."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = PlainIds(byte_path), PieceIds(piece_path)
        self.spelled = self.a.spellings(), self.b.model.bytes_of
        self.widths = [np.array([len(s) for s in table], np.int64) for table in self.spelled]
        self.n_a, self.n_b = map(len, self.spelled)
        self.digits = [str(i) for i in range(max(self.n_a, self.n_b))]
        self.known = Remembered(None, MOST_UNITS)  # units by key; asked by ``get`` only

    # ---- units ------------------------------------------------------------

    def cut(self, text: str) -> list[str] | None:
        """Keys of the units both tokenizers treat apart; None if the text has to stay whole."""
        if (
            SPACE in text or text[0] in " \n" or text[-1] == " " or "  " in text
            or " \n" in text or JOINED.search(text)
        ):
            return None
        return text.replace("\n", " \n").split(" ")

    def _given_back(self, side: int, ids: list[list[int]], want: list[bytes]) -> np.ndarray:
        """Which units the ids of one side spell."""
        table, flat = self.spelled[side], list(chain.from_iterable(ids))
        if [len(w) for w in want] == self._lengths(side, ids, flat) and (
            b"".join(map(table.__getitem__, flat)) == b"".join(want)
        ):
            return np.ones(len(want), bool)
        spelled = [b"".join([table[i] for i in unit]) for unit in ids]
        return np.array([x == w for x, w in zip(spelled, want)], bool)

    def _lengths(self, side: int, ids: list[list[int]], flat: list[int]) -> list[int]:
        ends = np.concatenate([[0], self.widths[side][np.array(flat, np.int64)].cumsum()])
        return np.diff(ends[np.cumsum([0, *map(len, ids)])]).tolist()

    def learn(self, keys: list[str], wholes: list[str]) -> list[bytes]:
        """Units by their keys, then whole texts, aligned."""
        literals = [self.b.literal(k) for k in keys]
        want = [u.encode() for u in literals] + [b" " + t.encode() for t in wholes]
        of_a = [*map(self.a.ids_of, literals)]
        of_a += [np.frombuffer(self.a.encode(" " + t), IDS).tolist() for t in wholes]
        of_b = self.b.by_library(literals) if literals else []
        of_b += [np.frombuffer(e, IDS).tolist() for e in self.b.encode_batch(wholes)[0]]
        out = [LOST] * len(want)
        good = np.flatnonzero(self._given_back(0, of_a, want) & self._given_back(1, of_b, want)).tolist()
        for start in range(0, len(good), UNITS_AT_ONCE):
            some = good[start : start + UNITS_AT_ONCE]
            found = self._align([of_a[i] for i in some], [of_b[i] for i in some])
            for i, unit in zip(some, found):
                out[i] = unit
        return out

    def _align(self, of_a: list[list[int]], of_b: list[list[int]]) -> list[bytes]:
        """Both sides' ids of units that spell the same bytes, laid end to end as one interval."""
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (of_a, of_b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (of_a, of_b))
        ends_a, ends_b = self.widths[0][ids_a].cumsum(), self.widths[1][ids_b].cumsum()
        cut_a, cut_b = shared_cuts(ends_a, ends_b, np.array([len(ids_a)]), np.array([len(ids_b)]))
        return self._units(n_a, n_b, ids_a, ids_b, cut_a, cut_b)

    def _units(self, n_a, n_b, ids_a, ids_b, cut_a, cut_b) -> list[bytes]:
        start_a, start_b = (np.concatenate([[0], c[:-1] + 1]) for c in (cut_a, cut_b))
        size_a, size_b = cut_a - start_a + 1, cut_b - start_b + 1
        # the groups of unit i are stops[i]:stops[i + 1]
        stops = np.concatenate([[0], np.searchsorted(cut_a, n_a.cumsum())])
        links = size_a * size_b
        written = self._written(ids_a, ids_b, cut_a, cut_b, links)
        found = self._links(ids_a, ids_b, start_a, start_b, cut_a, cut_b, links)
        unit_of = np.repeat(np.arange(len(n_a)), np.diff(stops))
        span = self.n_a * self.n_b
        keys, times = summed(
            np.concatenate([unit_of[group] * span + pair for group, pair, _ in found]),
            None if all(w is None for *_, w in found) else np.concatenate(
                [np.ones(len(pair), np.int64) if w is None else w for _, pair, w in found]
            ),
        )
        places = np.searchsorted(keys, np.arange(len(n_a) + 1) * span)
        n_links = np.add.reduceat(links, stops[:-1])
        heads = np.stack([n_a, n_b, np.diff(stops), n_links, np.diff(places)], 1).astype(HEAD).tobytes()
        pairs, counts = (keys % span).tobytes(), times.tobytes()
        bounds, places, out = stops.tolist(), places.tolist(), []
        for i, once in enumerate((n_links == np.diff(places)).tolist()):
            lo, hi = 8 * places[i], 8 * places[i + 1]
            out.append(
                heads[HEAD_BYTES * i : HEAD_BYTES * (i + 1)]
                + pairs[lo:hi]
                + (b"" if once else counts[lo:hi])
                + ";".join(written[bounds[i] : bounds[i + 1]]).encode()
            )
        return out

    def _written(self, ids_a, ids_b, cut_a, cut_b, links) -> list[str]:
        digits, out, i, k = self.digits, [], 0, 0
        a, b = ids_a.tolist(), ids_b.tolist()
        for j, m, n in zip((cut_a + 1).tolist(), (cut_b + 1).tolist(), links.tolist()):
            if n == 1:
                out.append(f"{a[i]}|{b[k]}")
            else:
                left, right = ",".join([digits[x] for x in a[i:j]]), ",".join([digits[x] for x in b[k:m]])
                out.append(f"{left}|{right}")
            i, k = j, m
        return out

    def _links(self, ids_a, ids_b, start_a, start_b, cut_a, cut_b, links) -> list[tuple]:
        """All linked pairs as (group, pair, links or None for one each); of very large groups
        the distinct pairs."""
        found = []
        for g in np.flatnonzero(links > WRITTEN_LINKS).tolist():
            left = np.unique(ids_a[start_a[g] : cut_a[g] + 1], return_counts=True)
            right = np.unique(ids_b[start_b[g] : cut_b[g] + 1], return_counts=True)
            ids = (left[0][:, None] * self.n_b + right[0]).ravel()
            found.append((np.full(len(ids), g), ids, np.outer(left[1], right[1]).ravel()))
        some = np.flatnonzero(links <= WRITTEN_LINKS)
        group = np.repeat(some, links[some])
        first = np.repeat(links[some].cumsum() - links[some], links[some])
        place, size_b = np.arange(len(group)) - first, (cut_b - start_b + 1)[group]
        x = ids_a[start_a[group] + place // size_b]
        y = ids_b[start_b[group] + place % size_b]
        return [*found, (group, x * self.n_b + y, None)]

    # ---- texts ------------------------------------------------------------

    def align(self, texts: list[str]) -> dict[str, list | np.ndarray | pa.Array]:
        """Columns of ``ALIGNED`` but for the id, one row a text."""
        cuts = [self.cut(t) if t else [] for t in texts]
        whole = [i for i, keys in enumerate(cuts) if keys is None]
        number: dict[str, int] = {}
        for keys in cuts:
            if keys:
                number.update(dict.fromkeys(keys))
        units = self._units_of(list(number), [texts[i] for i in whole])
        for n, key in enumerate(number):
            number[key] = n
        first_whole = len(number)
        places = [
            np.fromiter(map(number.__getitem__, keys), np.int64, len(keys)) if keys is not None else None
            for keys in cuts
        ]
        for n, i in enumerate(whole):
            places[i] = np.array([first_whole + n])
        sizes = np.array([len(p) for p in places])
        at = np.concatenate(places) if places else np.empty(0, np.int64)
        text_of = np.repeat(np.arange(len(texts)), sizes)
        heads = np.frombuffer(b"".join([u[:HEAD_BYTES] for u in units]), HEAD).reshape(-1, 5)
        heads = heads.astype(np.int64)
        lost = np.zeros(len(texts), bool)
        if len(at):
            lost[text_of[heads[at, 0] == NO_TOKENS]] = True
        kept = ~lost[text_of]
        at, text_of = at[kept], text_of[kept]
        out = {
            name: np.bincount(text_of, heads[at, c], len(texts)).astype(np.int64)
            for c, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))
        }
        widths = 8 * heads[:, 4]
        starts = (HEAD_BYTES + widths + np.where(heads[:, 3] == heads[:, 4], 0, widths)).tolist()
        written = [u[i:] for u, i in zip(units, starts)]
        out["groups_sha256"] = [
            "" if gone or not len(p)
            else hashlib.sha256(b";".join([written[i] for i in p.tolist()])).hexdigest()
            for p, gone in zip(places, lost.tolist())
        ]
        return out | self._pairs(units, heads, at, text_of, len(texts))

    def _units_of(self, keys: list[str], wholes: list[str]) -> list[bytes]:
        known, missing, out = self.known, [], []
        for key in keys:
            unit = known.get(key)
            if unit is None:
                unit = known.older.get(key)
                if unit is None:
                    missing.append(key)
                else:
                    known.keep(key, unit)
            out.append(unit)
        made = iter(self.learn(missing, wholes))
        for i, (key, unit) in enumerate(zip(keys, out)):
            if unit is None:
                out[i] = next(made)
                if len(key) <= 64:
                    known.keep(key, out[i])
        return out + list(made)

    def _pairs(self, units, heads, at, text_of, n: int) -> dict[str, pa.Array]:
        """Each text's distinct pairs, ascending, and how many links each has in it."""
        sizes = heads[:, 4]
        starts = sizes.cumsum() - sizes
        ends = (HEAD_BYTES + 8 * sizes).tolist()
        pairs = np.frombuffer(b"".join([u[HEAD_BYTES:i] for u, i in zip(units, ends)]), np.int64)
        times = np.ones(len(pairs), np.int64)
        for i in np.flatnonzero(heads[:, 3] != sizes).tolist():
            own = np.frombuffer(units[i][ends[i] : ends[i] + 8 * sizes[i]], np.int64)
            times[starts[i] : starts[i] + sizes[i]] = own
        span = max(len(units), 1)
        distinct, copies = summed(text_of * span + at, None)
        text, unit = distinct // span, distinct % span
        rows = np.repeat(np.arange(len(distinct)), sizes[unit])
        place = np.arange(len(rows)) - np.repeat(sizes[unit].cumsum() - sizes[unit], sizes[unit])
        place += starts[unit][rows]
        span = self.n_a * self.n_b
        keys, links = summed(text[rows] * span + pairs[place], times[place] * copies[rows])
        offsets = np.searchsorted(keys, np.arange(n + 1) * span)
        offsets = pa.array(offsets, pa.int32())
        return {
            "pairs": pa.ListArray.from_arrays(offsets, pa.array(keys % span)),
            "times": pa.ListArray.from_arrays(offsets, pa.array(links)),
        }


def summed(keys: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's weights (None: 1 each)."""
    if weights is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[starts], np.add.reduceat(weights, starts) if len(starts) else weights


def align_texts(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per row the sizes of both encodings, its groups, and its linked pairs of ids: a pair is
    ``a * n_b + b`` with ``n_b`` the ids of the second tokenizer, ``times`` its links in the text."""

    def run(batches):
        aligner = of_worker(Aligner, byte_path, piece_path)
        names = [part.split()[0] for part in ALIGNED.split(", ")]
        for batch in slices_by_size(batches, "text", BATCH_ROWS, BATCH_BYTES):
            found = aligner.align(batch.column("text").to_pylist())
            columns = [
                c if isinstance(c, pa.Array) else pa.array(c) for c in (found[n] for n in names[1:])
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    return texts_of(docs).mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """pair, n: the rows of ``aligned`` that hold it; a: its first id."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair")
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    return counts.select("pair", "n", F.expr(f"pair div {n_b}L").alias("a"))


def frequent_from(counts: DataFrame, most: int) -> tuple[int, bool]:
    """The least power of two so that at most ``most`` pairs have that count or more, and
    whether any pair has less."""
    levels = counts.groupBy(F.length(F.bin("n")).alias("level")).count().collect()
    sizes = {row["level"]: row["count"] for row in levels}
    level = max(sizes, default=0) + 1
    held = 0
    while level > 1 and held + sizes.get(level - 1, 0) <= most:
        level -= 1
        held += sizes.get(level, 0)
    return 1 << (level - 1), held < sum(sizes.values())


def link_counts(
    docs: DataFrame, byte_path: str, piece_path: str, staging: Staging, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row."""
    n_b = piece_ids(piece_path)
    aligned = align_texts(docs, byte_path, piece_path)
    aligned = staging.write(aligned.withColumn("tag", F.monotonically_increasing_id()), "aligned")
    counts = staging.write(pair_counts(aligned, n_b), "pair-counts")
    # at most one row for each id of the first tokenizer
    top = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("top")))
    marked = counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    least, more = frequent_from(counts, hot_pairs)
    links = aligned.select("tag", F.inline(F.arrays_zip("pairs", "times")))
    links = links.withColumnRenamed("pairs", "pair")
    hot = F.broadcast(marked.where(F.col("n") >= least))
    met = links.join(hot, "pair")
    if more:
        rare = links.join(F.broadcast(counts.where(F.col("n") >= least).select("pair")), "pair", "left_anti")
        met = met.unionByName(rare.join(marked.where(F.col("n") < least), "pair"))
    sums = met.groupBy("tag").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(sums, "tag", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )


def piece_ids(path: str) -> int:
    """How many ids a sentencepiece model has."""
    import sentencepiece

    return len(sentencepiece.SentencePieceProcessor(model_file=path))
