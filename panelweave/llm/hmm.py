"""A hidden Markov language model.

A hidden state emits a symbol: one of about ``OWN`` words with the highest training counts, or a class of all other words (``CLASSES``
classes by word hash), which emits the word in proportion to its training count. So the table of states is of fixed size, and
frequent words have emissions of their own in every state. Baum-Welch runs over all
training texts: each task adds up expected counts of its texts, and only their sums, of fixed size, meet. It ends when a round gains
less than ``TOLERANCE`` a token, or after ``rounds``. Word counts grow with the
corpus and stay a distributed table: the ``FREQUENT`` words at its head are sent to all tasks, all others are joined, as they are too
rare to crowd a task. The likelihood of a text is exact: the scaled forward recursion over all its words and its end.

Training cuts texts into sequences of ``SEQUENCE`` tokens, so a sweep over many of them at once stays in numpy; scoring
never cuts. Words are told apart by 64-bit hashes.

A null or empty text is its end alone. Ids are numbers; a null id is taken as the empty text when training rows are picked. Repeated rows
count as often as they stand there and are scored alike. Without training rows every word is unknown and states are uniform.
An empty table gives no rows, and a very long text is scored whole. Columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm import words as W
from panelweave.workspace import materialise

CLASSES = 1 << 14
#: Words that may have emissions of their own; of two that share one of ``SLOTS`` slots by hash, the more frequent one has.
OWN = 1 << 14
SLOTS = 1 << 18
#: log10 a token that another round must have gained.
TOLERANCE = 0.01
#: Words whose counts go to every task.
FREQUENT = 200_000
SEQUENCE = 128
#: Bytes of text whose forward recursions run side by side.
SCORED_BYTES = 2 << 20
#: Distinct words that a task counts before it passes them on.
_HELD = 1 << 20
#: The token that ends a text.
END = np.uint64(0xE7037ED1A0B428DB)
_SLICES = 64
_SEED = 17
_SMOOTH = 0.1


def held_out(key: object) -> bool:
    return zlib.crc32(b"" if key is None else str(key).encode()) % 10 == 0


def tokens(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of each text, its end last, and where each text's tokens begin and end."""
    block = W.lower_ascii(block)
    found = W.words(block)
    n = block.last - block.first
    count = np.bincount(found.text, minlength=n)
    cuts = np.append(0, np.cumsum(count + 1))
    out = np.full(cuts[-1], END, np.uint64)
    if len(found.starts):
        out[np.arange(len(found.starts)) + found.text] = W.hash_spans(block.data, found.starts, found.ends)
    return out, cuts


def class_of(hashed: np.ndarray, classes: int) -> np.ndarray:
    return (hashed % np.uint64(classes)).astype(np.int64)


def symbols(hashed: np.ndarray, own: np.ndarray, classes: int) -> np.ndarray:
    """The class of each word, or ``classes`` and its place among the sorted ``own`` words."""
    found = class_of(hashed, classes)
    if len(own):
        place = np.zeros(SLOTS, np.int32)
        place[class_of(own, SLOTS)] = np.arange(len(own))
        at = place[class_of(hashed, SLOTS)]
        found = np.where(own[at] == hashed, classes + at, found)
    return found


@dataclass
class Chain:
    """Start, transition and symbol emission probabilities (states by row)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def first(cls, symbol_counts: np.ndarray, states: int) -> Chain:
        """The counted symbols, disturbed for each state by a fixed rule; states tend to stay."""
        noise = W.mix(np.arange(1, states * len(symbol_counts) + 1, dtype=np.uint64) * np.uint64(_SEED))
        spread = 0.25 + (noise >> np.uint64(11)).astype(float) / 2**53 * 1.5
        emit = (symbol_counts + _SMOOTH) * spread.reshape(states, -1)
        stay = 0.9 * np.eye(states) + 0.1 / states
        return cls(np.full(states, 1 / states), stay, emit / emit.sum(axis=1, keepdims=True))

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, symbol_counts: np.ndarray) -> Chain:
        """From expected counts; a state's symbols are smoothed by the counted symbols."""
        back = (symbol_counts + _SMOOTH) / (symbol_counts + _SMOOTH).sum()
        emit = emit + back * (0.01 * emit.sum(axis=1, keepdims=True) + 1)
        start, move = start + 1, move + 1
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def _layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences longest first, and how many of them are still running at each step."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths[order[0]]) if len(order) else 0
    running = len(lengths) - np.searchsorted(lengths[order][::-1], np.arange(longest), "right")
    return order, running


def log_likelihoods(chain: Chain, classes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """log10 probability of the classes (or symbols) of each sequence: the scaled forward recursion, side by side."""
    lengths = np.diff(cuts)
    order, running = _layout(lengths)
    starts, emit = cuts[:-1][order], np.ascontiguousarray(chain.emit.T)
    out, alpha = np.zeros(len(lengths)), None
    for t, n in enumerate(running.tolist()):
        seen = emit[classes[starts[:n] + t]]
        alpha = (alpha[:n] @ chain.move if t else chain.start) * seen
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        out[:n] += np.log10(scale)
    result = np.empty(len(lengths))
    result[order] = out
    return result


def expected_counts(chain: Chain, classes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions over the sequences, and their log10 likelihood."""
    lengths = np.diff(cuts)
    order, running = _layout(lengths)
    starts, emit = cuts[:-1][order], np.ascontiguousarray(chain.emit.T)
    states = len(chain.start)
    alphas, scales, seen = [], [], []
    for t, n in enumerate(running.tolist()):
        seen.append(emit[classes[starts[:n] + t]])
        alpha = (alphas[-1][:n] @ chain.move if t else chain.start) * seen[-1]
        scales.append(alpha.sum(axis=1))
        alphas.append(alpha / scales[-1][:, None])
    moves = np.zeros((states, states))
    gamma = np.empty((len(classes), states))
    beta = np.ones((int(running[0]) if len(running) else 0, states))
    for t in range(len(running) - 1, -1, -1):
        n = running[t]
        gamma[starts[:n] + t] = alphas[t] * beta[:n]
        if t:
            later = seen[t] * beta[:n] / scales[t][:, None]
            moves += alphas[t - 1][:n].T @ later
            beta[:n] = later @ chain.move.T
    emissions = np.stack([np.bincount(classes, weights=gamma[:, k], minlength=chain.emit.shape[1]) for k in range(states)])
    begin = gamma[starts].sum(axis=0)
    return begin, moves * chain.move, emissions, float(sum(np.log10(s).sum() for s in scales))


def _training(batch: pa.RecordBatch, limit: int = W.BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and cuts of the training texts of a batch, block by block."""
    chosen = batch.filter(pa.array([not held_out(k) for k in batch.column(0).to_pylist()], pa.bool_()))
    if chosen.num_rows:
        for block in W.blocks(chosen.column(1), limit):
            yield tokens(block)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, counts, held = [], [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        word, index = np.unique(np.concatenate(words), return_inverse=True)
        return word, np.bincount(index, weights=np.concatenate(counts)).astype(np.int64)

    for batch in batches:
        for hashed, _ in _training(batch):
            word, count = np.unique(hashed, return_counts=True)
            words.append(word)
            counts.append(count)
            held += len(word)
            if held > 2 * _HELD:
                word, count = merged()
                if len(word) > _HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], ["word", "count"])
                    words, counts, held = [], [], 0
                else:
                    words, counts, held = [word], [count], len(word)
    if words:
        word, count = merged()
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], ["word", "count"])


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (hash) and ``count`` over the training rows of ``id``, ``text``; each task adds up its own first."""
    return docs.mapInArrow(_count, "word long, count long").groupBy("word").agg(F.sum("count").alias("count"))


def _sequences(cuts: np.ndarray) -> np.ndarray:
    """Cuts with others added so that no piece is longer than ``SEQUENCE``."""
    lengths = np.diff(cuts)
    pieces = -(-lengths // SEQUENCE)
    first = np.repeat(np.cumsum(pieces) - pieces, pieces)
    inner = np.repeat(cuts[:-1], pieces) + (np.arange(pieces.sum()) - first) * SEQUENCE
    return np.append(inner, cuts[-1])


def _pack(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in parts])


def _expect(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, own = sent.value
        classes, total = chain.emit.shape[1] - len(own), None
        for batch in batches:
            for hashed, cuts in _training(batch):
                begin, moves, emissions, likelihood = expected_counts(chain, symbols(hashed, own, classes), _sequences(cuts))
                packed = _pack([begin, moves, emissions, np.array([likelihood])])
                total = packed if total is None else total + packed
        if total is not None:
            parts = np.array_split(total, _SLICES)
            columns = [pa.array(range(_SLICES), pa.int32()), pa.array([p.astype("<f8").tobytes() for p in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "sums"])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums = np.frombuffer(packed, "<f8")
            total[i] = total[i] + sums if i in total else sums
    if total:
        columns = [pa.array(list(total), pa.int32()), pa.array([s.astype("<f8").tobytes() for s in total.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["slice", "sums"])


_NONE = np.zeros(0, np.uint64)


def baum_welch(
    docs: DataFrame, symbol_counts: np.ndarray, states: int, rounds: int, own: np.ndarray = _NONE, tolerance: float = 0.0
) -> tuple[Chain, list[float]]:
    """The chain after passes over all training rows, and the log10 likelihood before each: ``rounds`` passes, or fewer where the
    last one but one gained less than ``tolerance`` a token. ``symbol_counts``: of the classes, then of the sorted ``own`` words."""
    chain, likelihoods = Chain.first(symbol_counts, states), []
    for _ in range(rounds):
        sent = docs.sparkSession.sparkContext.broadcast((chain, own))
        sums = docs.mapInArrow(_expect(sent), "slice int, sums binary").repartition("slice").mapInArrow(_add, "slice int, sums binary")
        # Sums of fixed size, whatever the number of texts.
        parts = {r["slice"]: np.frombuffer(r["sums"], "<f8") for r in sums.collect()}
        sent.unpersist()
        if not parts:
            break
        total = np.concatenate([parts[i] for i in range(_SLICES)])
        begin, moves, emissions, likelihood = np.split(total, np.cumsum([states, states**2, states * len(symbol_counts)]))
        chain = Chain.of_counts(begin, moves.reshape(states, states), emissions.reshape(states, -1), symbol_counts)
        likelihoods.append(float(likelihood[0]))
        if len(likelihoods) > 1 and likelihoods[-1] - likelihoods[-2] < tolerance * symbol_counts.sum():
            break
    return chain, likelihoods


@dataclass
class Model:
    """What scoring sends to all tasks: of fixed size but for ``words``, which has ``FREQUENT`` at most, and ``own``, ``OWN`` of these."""

    chain: Chain
    words: np.ndarray
    counts: np.ndarray
    own: np.ndarray
    #: log10 of what the counts of a symbol's words are divided by.
    symbol_base: np.ndarray
    train_tokens: int
    vocabulary: int
    #: log10 likelihood of the training rows before each round.
    likelihoods: list[float]

    def symbols(self, hashed: np.ndarray) -> np.ndarray:
        return symbols(hashed, self.own, len(self.symbol_base) - len(self.own))


def train(
    docs: DataFrame, states: int = 6, rounds: int = 5, classes: int = CLASSES, frequent: int = FREQUENT, *, own: int = OWN, tolerance: float = TOLERANCE
) -> tuple[Model, DataFrame]:
    """The model, and the table of the words that it does not hold, from rows of ``id``, ``text``."""
    counted = materialise(count_words(docs), "words")
    by_count = counted.groupBy("count").agg(F.count("*").alias("n")).orderBy(F.col("count").desc())
    # Counts that occur are few: up to the square root of twice the tokens.
    least, room = None, frequent
    for row in by_count.toLocalIterator():
        room -= row["n"]
        if room < 0:
            break
        least = row["count"]
    of_class = counted.groupBy(F.col("word").bitwiseAND(classes - 1).alias("class")).agg(F.sum("count").alias("tokens"), F.count("*").alias("words"))
    class_counts, class_words = np.zeros(classes), np.zeros(classes)
    for row in of_class.collect():
        class_counts[row["class"]], class_words[row["class"]] = row["tokens"], row["words"]
    head = counted.where(F.col("count") >= least).toArrow() if least else pa.table({"word": pa.array([], pa.int64()), "count": pa.array([], pa.int64())})
    words = head.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    words, counts = words[order], head.column("count").to_numpy()[order]
    train_tokens, vocabulary = int(class_counts.sum()), int(class_words.sum())
    # The most frequent words leave their classes, one a slot; of equal counts, the least hashes.
    alone = np.argsort(-counts, kind="stable")[:own]
    alone = np.sort(alone[np.unique(class_of(words[alone], SLOTS), return_index=True)[1]])
    np.subtract.at(class_counts, class_of(words[alone], classes), counts[alone])
    np.subtract.at(class_words, class_of(words[alone], classes), 1)
    chain, likelihoods = baum_welch(docs, np.append(class_counts, counts[alone]), states, rounds, words[alone], tolerance)
    base = np.log10(np.append(class_counts + _SMOOTH * (class_words + 1), counts[alone] + _SMOOTH))
    model = Model(chain, words, counts, words[alone], base, train_tokens, vocabulary, likelihoods)
    return model, counted.where(F.col("count") < (least or 1 << 62))


_SCORED = pa.schema(
    [("uid", pa.int64()), ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("counted", pa.float64()), ("within", pa.float64()), ("rare", pa.list_(pa.int64()))]
)


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        known_log = np.log10(model.counts + _SMOOTH)
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for block in W.blocks(batch.column(1), SCORED_BYTES):
                n = block.last - block.first
                hashed, cuts = tokens(block)
                emitted = model.symbols(hashed)
                chained = log_likelihoods(model.chain, emitted, cuts)
                at = np.minimum(np.searchsorted(model.words, hashed), max(len(model.words) - 1, 0))
                known = model.words[at] == hashed if len(model.words) else np.zeros(len(hashed), bool)
                counted = np.where(known, known_log[at] if len(known_log) else 0.0, 0.0)
                many = np.add.reduceat(known, cuts[:-1], dtype=np.int64)
                sums = np.add.reduceat(counted, cuts[:-1])
                within = chained - np.add.reduceat(model.symbol_base[emitted], cuts[:-1])
                rare = hashed[~known].view(np.int64)
                offsets = np.append(0, np.cumsum(np.diff(cuts) - many)).astype(np.int32)
                ids = batch.column(0).slice(block.first, n)
                columns = [
                    pa.array(uid + np.arange(n)),
                    ids,
                    pa.array([held_out(k) for k in ids.to_pylist()], pa.bool_()),
                    pa.array(np.diff(cuts), pa.int64()),
                    pa.array(many),
                    pa.array(sums),
                    pa.array(within),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(rare)),
                ]
                uid += n
                yield pa.RecordBatch.from_arrays(columns, schema=_SCORED)

    return run


def score(docs: DataFrame, states: int = 6, rounds: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (smoothed word counts) and ``score``
    (the model's log10 probability of the text and its end)."""
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    model, others = train(docs, states, rounds)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "uid long, id long, held_out boolean, n_tokens long, n_known long, counted double, within double, rare array<long>"
    rows = materialise(docs.mapInArrow(_score(sent), schema), "scored")
    rare = rows.select("uid", F.explode("rare").alias("word")).groupBy("uid", "word").agg(F.count("*").alias("times"))
    found = rare.join(others, "word", "left")
    log = F.col("times") * F.log10(F.coalesce("count", F.lit(0)) + _SMOOTH)
    sums = found.groupBy("uid").agg(F.sum(log).alias("log"), F.sum(F.when(F.col("count").isNotNull(), F.col("times"))).alias("known"))
    joined = rows.drop("rare").join(sums, "uid", "left")
    counted = F.col("counted") + F.coalesce("log", F.lit(0.0))
    base = np.log10(model.train_tokens + _SMOOTH * (model.vocabulary + 1))
    return joined.select(
        F.col("id").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (counted - F.col("n_tokens") * float(base)).alias("base_score"),
        (counted + F.col("within")).alias("score"),
    )
