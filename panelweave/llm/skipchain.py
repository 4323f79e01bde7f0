"""Personal data by a skip-chain conditional random field.

Fixed patterns find addresses of mail and network, card and phone numbers (the base). The field then looks at every token with a
digit or an at sign: such a token has a label, neighbouring tokens share a chain potential, and tokens of one document
that are the same, or end in the same seven digits, share a skip potential, however far apart. Two like tokens are tied to each
other; of more, each is tied to one hub, so m tokens have m ties. Where the base holds the label of one, that is the hub's label and
each of the others is tied to it, whatever their number; labels that differ each have a tie. Digits of a whole span of the base and of
a run of neighbouring number tokens count as well, joined, and tie the tokens they stand in. Loopy belief propagation runs over all
documents of a block at once, each until its messages settle. Spans of the base stay as they are and hold their labels fixed; tokens whose label is surer than ``SURE`` are
added. All other tokens can only be outside.

The field is trained on the base of the whole table: labelled tokens are counted by their features and their neighbours'
labels, and the pseudo-likelihood of the ``PATTERNS`` most frequent of these is maximised on the driver. Part of each
pattern's weight is trained with its exact shape hidden, so that neighbours and ties count where a shape is new.

Patterns are searched in time linear in the text. Of a token of more than 200 characters, the exact shape (one of its features) is that
of its first 200; its coarse kind, its ties and its spans are of all of it. Null text: empty, no spans. Repeated rows are searched alike. An
empty table gives no rows. Columns other than id and text are read by ``mask`` only, which returns all columns as they came.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
_LABELS = len(KINDS) + 1
#: Patterns of labelled tokens that training sees, the most frequent ones.
PATTERNS = 20_000
#: Least probability of an added label.
SURE = 0.9
#: What a tie is worth to equal labels before training.
AGREE = 3.0
#: Share of a pattern's weight that is trained with its exact shape hidden.
_HIDDEN = 0.3
#: Messages are half replaced for ``_HALVES`` rounds, then less and less, so that those that swing come to rest. They end once none
#: changes by ``_CHANGE``, or after ``_ROUNDS`` and four for each token.
_HALVES, _ROUNDS, _CHANGE = 100, 1000, 1e-4
_BUCKETS = 1 << 14

# The base patterns. A number is only sought from its first digit on, which finds the same matches.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_NUMBER = re.compile(r"[0-9+(][0-9+()./-]*+")
_SHAPE = re.compile(r"[0-9]+|[^\W\d_]+")
_CORE = re.compile(r"[0-9A-Za-z+(](?:.*[0-9A-Za-z)])?", re.S)

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_LETTERS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return found


def _ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]


def _cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


_BASE: tuple[Callable[[str], list[Span]], ...] = (_emails, _ips, _cards, _phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    return [(k, *span) for k, find in enumerate(_BASE) for span in find(text)]


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for k, start, end in spans)


def features(token: str) -> tuple[int, int]:
    """The token's exact shape and its coarse kind, as bucket numbers. Both tell valid numbers from others."""
    digits = _digits(token)
    core = token.strip(".,;:!?\"'()[]{}<>")
    parts = core.split(".")
    octets = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    valid = "L" * (13 <= len(digits) <= 19 and luhn(digits)) + "O" * octets + "@" * bool(_emails(token))
    shape = _SHAPE.sub(lambda m: f"9{min(len(m[0]), 20)}" if m[0][0].isdigit() else "a", token[:200])
    signs = "".join(c for c in "+(@" if c in token)
    coarse = f"{min(len(digits), 20)}|{signs}|{valid}|{core.isdigit()}"
    numbers = []
    for name in (f"{shape}|{valid}", f"~{coarse}"):
        numbers.append(int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "big") % _BUCKETS)
    return numbers[0], numbers[1]


def _tie_names(token: str) -> list[str]:
    """What ties a token to others: its letters and digits, and its last seven digits."""
    plain = "".join(c for c in token.lower() if c.isalnum())
    digits = _digits(token)
    names = [plain] if len(plain) >= 5 else []
    if len(digits) >= 7 and digits[-7:] != plain:
        names.append(digits[-7:])
    return names


def _joined_names(text: str, spans: list[Span], tokens: list[int]) -> Iterator[tuple[str, list[int]]]:
    """The digits of ``spans``, joined: all of them and the last seven to nine, each with the tokens they stand in."""
    owners, parts = [], []
    for i, (start, end) in zip(tokens, spans):
        digits = _digits(text[start:end])
        parts.append(digits)
        owners += [i] * len(digits)
    digits = "".join(parts)
    for k in sorted({7, 8, 9, len(digits)}):
        if 7 <= k <= len(digits):
            yield digits[-k:], sorted(set(owners[-k:]))


@dataclass
class Graph:
    """Tokens of some documents. ``chain`` and ``ties`` are pairs of token numbers, the earlier first; ``hubs`` are pairs of
    hub and token, ``votes`` of token and the label of a like token; ``fixed`` is the label of the base, or -1."""

    document: np.ndarray
    spans: list[Span]
    features: np.ndarray
    fixed: np.ndarray
    chain: np.ndarray
    ties: np.ndarray
    hubs: np.ndarray
    votes: np.ndarray


def graph(texts: list[str], bases: list[list[tuple[int, int, int]]]) -> Graph:
    document, spans, shapes, fixed, chain, ties, hubs, votes = [], [], [], [], [], [], [], []
    n_hubs = 0
    for d, text in enumerate(texts):
        covered = sorted((start, end, k + 1) for k, start, end in bases[d])
        # Tokens by name, with the occurrence each belongs to: itself, or the span or run it is part of.
        seen: dict[str, dict[int, int]] = {}
        joined: dict[tuple[int, int, int], list[int]] = {}
        runs: list[list[int]] = [[]]
        before, after, reach = -1, 0, 0
        open_: list[tuple[int, int, int]] = []
        for m in _TOKEN.finditer(text):
            i, token = len(spans), m[0]
            start, end = m.span()
            while after < len(covered) and covered[after][0] < end:
                open_.append(covered[after])
                after += 1
            open_ = [c for c in open_ if c[1] > start]
            chained = before >= 0 and text[reach:start].isspace()
            if chained:
                chain.append((before, i))
            for name in _tie_names(token):
                seen.setdefault(name, {})[i] = i
            for c in open_:
                joined.setdefault(c, []).append(i)
            core = token.rstrip(".,;:!?")
            if not chained or not _NUMBER.fullmatch(core):
                runs.append([])
            if _NUMBER.fullmatch(core):
                runs[-1].append(i)
            if core != token:
                # A sentence or a part of one ends here.
                runs.append([])
            document.append(d)
            spans.append((start, end))
            shapes.append(features(token))
            fixed.append(min((c[2] for c in open_), default=-1))
            before, reach = i, end
        groups = [([(max(spans[i][0], c[0]), min(spans[i][1], c[1])) for i in own], own) for c, own in joined.items() if c[2] > 1]
        groups += [([spans[i] for i in run], run) for run in runs if len(run) > 1]
        for places, own in groups:
            for name, tied in _joined_names(text, places, own):
                here = seen.setdefault(name, {})
                occurrence = next((here[i] for i in tied if i in here), tied[0])
                for i in tied:
                    here.setdefault(i, occurrence)
        for like in seen.values():
            held: dict[int, set[int]] = {}
            for i, occurrence in like.items():
                if fixed[i] >= 0:
                    held.setdefault(fixed[i], set()).add(occurrence)
            n_like = len(set(like.values()))
            if held:
                # An occurrence's own label is no vote for it.
                votes += [(i, label) for i, o in like.items() for label in sorted(held) if len(held[label]) > (o in held[label])]
            elif n_like == 2 and len(like) == 2:
                ties.append((min(like), max(like)))
            elif n_like > 1:
                hubs += [(n_hubs, i) for i in like]
                n_hubs += 1
    as_pairs = lambda pairs: np.array(pairs, np.int64).reshape(-1, 2)
    return Graph(np.array(document, np.int64), spans, as_pairs(shapes), np.array(fixed, np.int64), as_pairs(chain), as_pairs(ties), as_pairs(hubs), as_pairs(votes))


@dataclass
class Field:
    """Potentials: of labels by feature bucket, of chained labels (earlier by row) and of tied labels."""

    unary: np.ndarray
    chain: np.ndarray
    tie: np.ndarray


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1, keepdims=True)
    return x - top - np.log(np.exp(x - top).sum(axis=-1, keepdims=True))


def beliefs(field: Field, g: Graph) -> np.ndarray:
    """Label probabilities of every token, by damped loopy belief propagation."""
    n = len(g.spans)
    local = field.unary[g.features[:, 0]] + field.unary[g.features[:, 1]]
    np.add.at(local, g.votes[:, 0], field.tie[g.votes[:, 1]])
    held = np.flatnonzero(g.fixed >= 0)
    local[held] = -1e3
    local[held, g.fixed[held]] = 0
    n_hubs = int(g.hubs[:, 0].max(initial=-1)) + 1
    # Hubs are nodes behind the tokens; nothing is known of them but their ties.
    local = np.concatenate([local, np.zeros((n_hubs, _LABELS))])
    spokes = g.hubs + np.array([n, 0])
    pairs = np.concatenate([g.chain, g.chain[:, ::-1], g.ties, g.ties[:, ::-1], spokes, spokes[:, ::-1]])
    sizes = [len(p) for p in (g.chain, g.ties, g.hubs) for _ in range(2)]
    if len(pairs):
        table = np.repeat(np.stack([field.chain, field.chain.T, *[field.tie, field.tie.T] * 2]), sizes, axis=0)
        kinds = np.cumsum([0, *sizes])
        back = np.concatenate([np.arange(kinds[k], kinds[k + 1]) for k in (1, 0, 3, 2, 5, 4)])
        source, target = pairs[:, 0], pairs[:, 1]
        # One end of each pair at least is a token.
        document = g.document[np.where(source < n, source, target)]
        message = np.zeros((len(pairs), _LABELS))
        live = np.arange(len(pairs))
        for r in range(_ROUNDS + 4 * n):
            total = local.copy()
            np.add.at(total, target[live], message[live])
            out = (total[source[live]] - message[back[live]])[:, :, None] + table[live]
            top = out.max(axis=1)
            new = _log_sum(top + np.log(np.exp(out - top[:, None, :]).sum(axis=1)))
            change = np.abs(np.exp(new) - np.exp(_log_sum(message[live]))).max(axis=1)
            step = 0.5 / max(1.0, r / _HALVES)
            message[live] = (1 - step) * message[live] + step * new
            moving = np.zeros(document.max() + 1, bool)
            moving[document[live][change >= _CHANGE]] = True
            live = live[moving[document[live]]]
            if not len(live):
                break
        np.add.at(local, target, message)
    return np.exp(_log_sum(local[:n])) if n else np.zeros((0, _LABELS))


def added_spans(g: Graph, texts: list[str], marginals: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) of sure tokens outside the base; chained tokens of one label are one span."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    label = marginals.argmax(axis=1) if len(marginals) else np.zeros(0, np.int64)
    sure = (label > 0) & (marginals.max(axis=1, initial=0) >= SURE) & (g.fixed < 0)
    chained = {int(b): int(a) for a, b in g.chain}
    last = -1
    for i in np.flatnonzero(sure).tolist():
        d, (start, end) = int(g.document[i]), g.spans[i]
        core = _CORE.search(texts[d], start, end)
        if not core:
            continue
        if chained.get(i) == last and last >= 0 and label[last] == label[i] and found[d]:
            found[d][-1] = (found[d][-1][0], found[d][-1][1], core.end())
        else:
            found[d].append((int(label[i]) - 1, core.start(), core.end()))
        last = i
    return found


def _neighbour_counts(g: Graph, label: np.ndarray) -> np.ndarray:
    """For each token: label of the one before and the one after (0 outside, as for none), and tied labels counted."""
    n = len(label)
    out = np.zeros((n, 2 + _LABELS), np.int64)
    out[:, :2] = -1
    out[g.chain[:, 1], 0] = label[g.chain[:, 0]]
    out[g.chain[:, 0], 1] = label[g.chain[:, 1]]
    for a, b in ((0, 1), (1, 0)):
        np.add.at(out, (g.ties[:, a], 2 + label[g.ties[:, b]]), 1)
    np.add.at(out, (g.votes[:, 0], 2 + g.votes[:, 1]), 1)
    # A hub without a label of the base is outside, as are its tokens.
    np.add.at(out, (g.hubs[:, 1], 2), 1)
    return out


_PATTERN = ["exact", "coarse", "label", "before", "after", *(f"tied_{k}" for k in range(_LABELS))]


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            texts = [t or "" for t in batch.column(0).slice(start, 512).to_pylist()]
            g = graph(texts, [base_spans(t) for t in texts])
            if len(g.spans):
                label = np.maximum(g.fixed, 0)
                rows = np.concatenate([g.features, label[:, None], _neighbour_counts(g, label)], axis=1)
                rows, counts = np.unique(rows, axis=0, return_counts=True)
                columns = [pa.array(rows[:, c], pa.int32()) for c in range(rows.shape[1])] + [pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*_PATTERN, "times"])


def fit(patterns: np.ndarray, times: np.ndarray, steps: int = 300, penalty: float = 1e-3) -> Field:
    """Maximise the penalised pseudo-likelihood of counted patterns by momentum steps of fixed number."""
    field = [np.zeros((_BUCKETS, _LABELS)), np.zeros((_LABELS, _LABELS)), np.zeros((_LABELS, _LABELS))]
    if not len(patterns):
        field[0][:, 0] = 10.0
        return Field(*field)
    buckets, index = np.unique(patterns[:, :2], return_inverse=True)
    index = index.reshape(-1, 2)
    label, before, after, tied = patterns[:, 2], patterns[:, 3], patterns[:, 4], patterns[:, 5:].astype(float)
    # Frequent patterns count by the root of their number, so that rare ones are learnt too.
    weight = np.sqrt(times.astype(float))
    weight /= weight.sum()
    aim = np.eye(_LABELS)[label]
    has_before, has_after = (before >= 0).astype(float)[:, None], (after >= 0).astype(float)[:, None]
    before, after = np.maximum(before, 0), np.maximum(after, 0)
    params = [np.zeros((len(buckets), _LABELS)), np.zeros((_LABELS, _LABELS)), np.zeros((_LABELS, _LABELS))]
    # Before any data, tied tokens agree and nothing else is known.
    prior = [0.0, 0.0, AGREE * np.eye(_LABELS)]
    params[2] += prior[2]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        grads = [penalty * (p - mean) for p, mean in zip(params, prior)]
        around = has_before * params[1][before] + has_after * params[1].T[after] + tied @ params[2]
        for shown, share in ((1.0, 1 - _HIDDEN), (0.0, _HIDDEN)):
            logits = shown * params[0][index[:, 0]] + params[0][index[:, 1]] + around
            error = (np.exp(_log_sum(logits)) - aim) * (share * weight)[:, None]
            np.add.at(grads[0], index[:, 1], error)
            if shown:
                np.add.at(grads[0], index[:, 0], error)
            np.add.at(grads[1], before, has_before * error)
            back = np.zeros_like(grads[1])
            np.add.at(back, after, has_after * error)
            grads[1] += back.T
            grads[2] += tied.T @ error
        # A tie has no direction.
        grads[2] = (grads[2] + grads[2].T) / 2
        for p, grad, m, v in zip(params, grads, first, second):
            m *= 0.9
            m += 0.1 * grad
            v *= 0.999
            v += 0.001 * grad**2
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    # A shape that was never seen says nothing for any kind.
    field[0][:, 0] = 1.0
    field[0][buckets] = params[0]
    return Field(field[0], params[1], params[2])


def train(docs: DataFrame, text: str = "text") -> Field:
    """A field fitted to the base labels of all documents, through the counts of their patterns."""
    schema = ", ".join([*(f"{c} int" for c in _PATTERN), "times long"])
    counted = docs.select(text).mapInArrow(_patterns, schema).groupBy(*_PATTERN).agg(F.sum("times").alias("times"))
    rows = counted.orderBy(F.col("times").desc(), *_PATTERN).limit(PATTERNS).toArrow()
    columns = [rows.column(c).to_numpy().astype(np.int64) for c in _PATTERN]
    return fit(np.stack(columns, axis=1), rows.column("times").to_numpy())


def _found(field: Field, texts: list[str]) -> Iterator[tuple[list, list]]:
    """Base spans and all spans of each text, by kind, then start."""
    bases = [base_spans(t) for t in texts]
    g = graph(texts, bases)
    added = added_spans(g, texts, beliefs(field, g))
    for base, more in zip(bases, added):
        yield base, sorted([*base, *more])


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for start in range(0, len(column), 256):
        yield start, [t or "" for t in column.slice(start, 256).to_pylist()]


def find(docs: DataFrame, field: Field | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, base spans counted by kind, ``base_spans``, all ``spans`` and ``n_added``."""
    sent = docs.sparkSession.sparkContext.broadcast(field or train(docs, text))
    names = [key, *(f"n_{k}" for k in KINDS), "n_added", "base_spans", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _texts(batch.column(1)):
                rows = []
                for base, spans in _found(sent.value, texts):
                    kinds = [s[0] for s in base]
                    rows.append((*(kinds.count(k) for k in range(len(KINDS))), len(spans) - len(base), span_text(base), span_text(spans)))
                columns = list(zip(*rows))
                arrays = [pa.array(c, pa.int64()) for c in columns[:-2]] + [pa.array(c, pa.string()) for c in columns[-2:]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), *arrays], names)

    kind = docs.schema[key].dataType.simpleString()
    longs = ", ".join(f"{n} long" for n in names[1:-2])
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {longs}, base_spans string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans, the one that begins first names all."""
    pieces, reach = [], 0
    for k, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= reach:
            pieces += [text[reach:start], f"[{KINDS[k].upper()}]"]
        reach = max(reach, end)
    return "".join([*pieces, text[reach:]])


def mask(docs: DataFrame, field: Field | None = None, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All columns of ``docs``, personal data in ``text`` masked and ``length``, where there is one, counted anew."""
    sent = docs.sparkSession.sparkContext.broadcast(field or train(docs, text))
    place = docs.columns.index(text)
    counted = docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _texts(batch.column(place)):
                part = batch.slice(start, len(texts))
                clean = [masked(t, spans) for t, (_, spans) in zip(texts, _found(sent.value, texts))]
                columns = part.columns
                clean = [t if known else None for t, known in zip(clean, part.column(place).is_valid().to_pylist())]
                columns[place] = pa.array(clean, part.schema.field(place).type)
                if counted is not None:
                    changed = [n if old in (None, t) else len(t) for n, old, t in zip(part.column(counted).to_pylist(), part.column(place).to_pylist(), clean)]
                    columns[counted] = pa.array(changed, part.schema.field(counted).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
