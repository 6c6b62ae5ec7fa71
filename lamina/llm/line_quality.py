"""Quality rules over lines labelled by a linear-chain conditional random field.

Every line of a text that has a word is content or boilerplate. The field scores a labelling
by the lines' own features and by which label follows which; Viterbi decoding finds the best
one. A document is kept if at least half of its characters lie in content lines and the plain
rules (too few words, too many repeated ones) do not fail it.

The field is trained here, by gradient steps on its likelihood, from a bounded sample of
labelled documents (``most_documents`` of each quality, chosen by a hash of the id, with
their whole texts). No line is labelled in the corpus, so all lines of a good document start
as content and all of a bad one as boilerplate; the decoded labels of the bad ones then
replace the guess, in a few rounds.

Null and empty texts have no words and fail the plain rules, as do texts of white space. Lines
without a word are ignored. Repeated rows and ids are judged one by one; extra columns
are not read. Without labels everything that passes the plain rules is kept.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import SPACES, slices, texts_of

SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
STRONG = b"!?"
BLANKS = SPACES.encode()
LEAST_WORDS, MOST_REPEATED = 50, 50
CONTENT_SHARE = 0.5
BOILERPLATE, CONTENT = 0, 1
N_FEATURES = 10
#: Longest run of lines in one training sequence; longer texts give several.
SEQUENCE = 128


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that the text has twice or more, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    total, covered = 0, 0  # covered: words before this place that are counted already
    for i, window in enumerate(windows):
        if window in often:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def count(data: bytes, kinds: bytes) -> int:
    return len(data) - len(data.translate(None, kinds))


def lines_of(data: bytes) -> list[bytes]:
    return [line for line in data.split(b"\n") if line.split()]


def line_features(lines: list[bytes]) -> np.ndarray:
    """One row of features per line."""
    out = np.empty((len(lines), N_FEATURES))
    seen: set[bytes] = set()
    for i, line in enumerate(lines):
        words, size = line.split(), len(line)
        symbols = count(line, SYMBOLS)
        out[i] = (
            1.0,
            min(len(words), 40) / 20 - 1,
            min(1.0, 4 * symbols / size),
            symbols / len(words) > 0.3,
            min(1.0, 2 * count(line, CAPITALS) / size),
            min(1.0, 4 * count(line, DIGITS) / size),
            min(1.0, 10 * count(line, STRONG) / size),
            line in seen,
            line.rstrip()[-1:] in (b".", b"!", b"?"),
            1 - len(set(words)) / len(words),
        )
        seen.add(line)
    return out


@dataclass
class Field:
    """Weights of a chain over the two labels: by feature, by pair of neighbours, at the start."""

    own: np.ndarray  # label, feature
    pair: np.ndarray  # label, next label
    start: np.ndarray

    def decode(self, features: np.ndarray) -> list[int]:
        """The best labelling (Viterbi); of equal ones that with content."""
        scores = (features @ self.own.T).tolist()
        (p00, p01), (p10, p11) = self.pair.tolist()
        s0, s1 = (float(x) for x in self.start)
        back: list[tuple[int, int]] = []
        a, b = s0 + scores[0][0], s1 + scores[0][1]
        for e0, e1 in scores[1:]:
            stay0, from1, from0, stay1 = a + p00, b + p10, a + p01, b + p11
            back.append((int(from1 >= stay0), int(stay1 >= from0)))
            a, b = max(stay0, from1) + e0, max(from0, stay1) + e1
        label = int(b >= a)
        path = [label]
        for step in reversed(back):
            label = step[label]
            path.append(label)
        return path[::-1]


def likelihood_slope(field: Field, x, y, mask):
    """Gradient of the mean log-likelihood of labelled sequences (rows padded to one length),
    by the forward and backward sums of all of them at once."""
    n, length, _ = x.shape
    emit = np.einsum("ntf,lf->ntl", x, field.own)
    forward, backward = np.empty((n, length, 2)), np.zeros((n, length, 2))
    forward[:, 0] = emit[:, 0] + field.start
    for t in range(1, length):
        joined = np.logaddexp.reduce(forward[:, t - 1, :, None] + field.pair, axis=1) + emit[:, t]
        forward[:, t] = np.where(mask[:, t, None], joined, forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        onward = field.pair + (emit[:, t + 1] + backward[:, t + 1])[:, None, :]
        joined = np.logaddexp.reduce(onward, axis=2)
        backward[:, t] = np.where(mask[:, t + 1, None], joined, 0.0)
    total = np.logaddexp.reduce(forward[:, -1], axis=1)[:, None, None]
    node = np.exp(forward + backward - total) * mask[:, :, None]
    truth = np.eye(2)[y] * mask[:, :, None]
    edge = np.exp(
        forward[:, :-1, :, None]
        + field.pair
        + (emit[:, 1:] + backward[:, 1:])[:, :, None, :]
        - total[:, :, :, None]
    )
    both = mask[:, 1:, None, None]
    met = truth[:, :-1, :, None] * truth[:, 1:, None, :]
    return (
        np.einsum("ntl,ntf->lf", truth - node, x) / n,
        ((met - edge) * both).sum(axis=(0, 1)) / n,
        (truth[:, 0] - node[:, 0]).sum(axis=0) / n,
    )


def train(
    sequences: list[np.ndarray], good: np.ndarray, rounds: int = 3, steps: int = 60,
    rate: float = 0.3, decay: float = 0.01,
) -> Field:
    """Fit the field to sequences of line features, each from a good or a bad document."""
    field = Field(np.zeros((2, N_FEATURES)), np.zeros((2, 2)), np.zeros(2))
    if not len(sequences) or good.all() or not good.any():
        field.own[CONTENT, 0] = 1.0
        return field
    longest = max(map(len, sequences))
    x = np.zeros((len(sequences), longest, N_FEATURES))
    mask = np.zeros((len(sequences), longest), bool)
    for i, s in enumerate(sequences):
        x[i, : len(s)], mask[i, : len(s)] = s, True
    y = np.where(good[:, None], CONTENT, BOILERPLATE) * np.ones((1, longest), np.int64)
    for _ in range(rounds):
        squares = [np.zeros((2, N_FEATURES)), np.zeros((2, 2)), np.zeros(2)]
        for _ in range(steps):
            slopes = likelihood_slope(field, x, y, mask)
            for w, g, s in zip((field.own, field.pair, field.start), slopes, squares):
                g = g - decay * w
                s += g * g
                w += rate * g / (np.sqrt(s) + 1e-8)
        for i in np.flatnonzero(~good):
            path = field.decode(sequences[i])
            # A bad document has boilerplate somewhere; one decoded without keeps its guess.
            if BOILERPLATE in path:
                y[i, : len(path)] = path
    return field


def fit(docs: DataFrame, labels: DataFrame, most_documents: int = 600) -> Field:
    """Train the field on a bounded sample of ``labels.quality`` 0 and 1."""
    known = labels.select(
        labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].alias("quality")
    ).where("quality IN (0, 1)")

    def chosen(value: int) -> DataFrame:
        ids = known.where(F.col("quality") == value).distinct()
        return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_documents)

    sample = chosen(0).union(chosen(1))  # bounded, so it may be broadcast

    def run(batches):
        for batch in slices(batches, 200):
            rows = []
            for text in batch.column("text").to_pylist():
                lines = lines_of(text.encode())
                rows.append(line_features(lines).tobytes() if lines else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array(rows, pa.binary())], names=["quality", "rows"]
            )

    found = texts_of(docs).join(F.broadcast(sample), "doc_id").select("quality", "text")
    found = found.select(F.col("quality").cast("int").alias("quality"), "text")
    table = found.mapInArrow(run, "quality int, rows binary").toPandas()
    sequences, good = [], []
    for quality, data in zip(table["quality"], table["rows"]):
        rows = np.frombuffer(data).reshape(-1, N_FEATURES)
        for at in range(0, len(rows), SEQUENCE):
            sequences.append(rows[at : at + SEQUENCE])
            good.append(quality == 1)
    return train(sequences, np.array(good, bool))


def judge(text: str, field: Field, share: float = CONTENT_SHARE) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content
    share, kept) of one text."""
    data = text.encode()
    words, lines = data.split(), lines_of(data)
    n, repeated = len(words), repeated_words(words)
    failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
    sizes = [len(line) for line in lines]
    held = 0
    if lines:
        labels = field.decode(line_features(lines))
        held = sum(size for size, label in zip(sizes, labels) if label == CONTENT)
    content = held / sum(sizes) if lines else 0.0
    return (
        n,
        len(text) - count(data, BLANKS),
        count(data, SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        failed,
        content,
        not failed and content >= share,
    )


COLUMNS = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "content_share": pa.float64(),
    "kept": pa.bool_(),
}


def judge_texts(docs: DataFrame, field: Field, share: float = CONTENT_SHARE) -> DataFrame:
    """doc_id and the figures and verdict of :func:`judge` for every row."""

    def run(batches):
        for batch in slices(batches, 1000):
            rows = [judge(t, field, share) for t in batch.column("text").to_pylist()]
            columns = zip(*rows) if rows else [[]] * len(COLUMNS)
            arrays = [pa.array(list(v), t) for v, t in zip(columns, COLUMNS.values())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays], names=["doc_id", *COLUMNS]
            )

    return texts_of(docs).mapInArrow(
        run,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, content_share double, kept boolean",
    )
