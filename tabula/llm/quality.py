"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

1. A document is a bag of passages of ``PASSAGE_WORDS`` words (the last one may be shorter; a text without words is one
   empty passage). A passage is described by what is seen on its surface: shares of bytes by kind and of each mark,
   pairs of neighbouring kinds, word and line shapes, repetition, and hashed words.
2. An encoder turns each description into a hidden vector h = tanh(x E + e). Gated attention weighs the passages of a
   bag by softmax of w . (tanh(V h) * sigmoid(U h)); the document is the weighted sum of its hidden vectors, and its
   score the logistic of a linear function of that sum. All of it is learnt from the document's label alone, so a
   passage of junk in good prose can get the weight that decides.
3. The model is fitted by Adam on a bounded sample: the first ``FIT_ROWS`` labelled documents in hash order that are
   not held out, of each at most ``FIT_PASSAGES`` passages, evenly spaced. Scoring reads every passage of every text;
   texts are described in runs of bounded size, and a long text keeps two numbers per passage.

Labels are read only from rows whose crc32(doc_id as text) mod 4 is not 2 (of several labels of a doc_id the greatest
counts). Scores see nothing but the text.

Cases: null and empty texts are one empty passage and get its score; without labels of both classes every score is
the share of good labels (0 without any label); repeated rows score alike; rows with a null id are scored and not
held out; an empty table gives no rows; names of further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep
from .shingles import POWERS, RUN_BYTES, mix64

#: Documented bounds of the fit: labelled documents, and passages of each of them.
FIT_ROWS, FIT_PASSAGES = 6_000, 256
PASSAGE_WORDS, WORD_SLOTS = 64, 128
HIDDEN, GATES, EPOCHS, BATCH, SEED = 32, 16, 12, 256, 7
#: Up to this many labelled ids are broadcast, more are joined by shuffle.
BROADCAST_IDS = 1_000_000

BLANK, LINE, LOWER, UPPER, DIGIT, MARK, HIGH = range(7)
KINDS = 7


def _byte_kinds() -> np.ndarray:
    kind = np.full(256, MARK, dtype=np.uint8)
    kind[[9, 11, 12, 13, 32]] = BLANK
    kind[10] = LINE
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = LOWER, UPPER, DIGIT, HIGH
    return kind


KIND = _byte_kinds()
#: Each mark (a byte that is neither blank, letter, digit nor high) has a column, the other bytes one per kind.
MARKS = np.flatnonzero(KIND == MARK)
CODE = KIND.copy()
CODE[MARKS] = KINDS + np.arange(len(MARKS))
CODES = KINDS + len(MARKS)
SHAPES = 9
WIDTH = CODES + KINDS * KINDS + SHAPES + WORD_SLOTS


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of bytes that end in a blank."""
    blank = KIND[raw] <= LINE
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _cut(text: bytes) -> Iterator[bytes]:
    """A text in pieces of whole passages of about RUN_BYTES."""
    if len(text) <= RUN_BYTES:
        yield text
        return
    starts, _ = _words(np.frombuffer(text + b"\n", dtype=np.uint8))
    at = starts[::PASSAGE_WORDS]
    if not len(at):
        yield b""
        return
    at[0] = 0
    begin = 0
    for i in range(1, len(at)):
        if at[i] - at[begin] >= RUN_BYTES:
            yield text[at[begin] : at[i]]
            begin = i
    yield text[at[begin] :]


def _runs(texts) -> Iterator[tuple[list[bytes], list[int]]]:
    """Pieces of texts and the number of the text of each, in runs of about RUN_BYTES."""
    run, of, size = [], [], 0
    for i, t in enumerate(texts):
        for piece in _cut(t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""):
            run.append(piece)
            of.append(i)
            size += len(piece)
            if size >= RUN_BYTES:
                yield run, of
                run, of, size = [], [], 0
    if run:
        yield run, of


def describe(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The descriptions of all passages of the pieces, and the piece of each."""
    raw = np.frombuffer(b"\n".join(run) + b"\n", dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in run])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    starts, ends = _words(raw)
    piece = np.searchsorted(offsets, starts, side="right") - 1
    n_words = np.bincount(piece, minlength=len(run))
    rank = np.arange(len(starts)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    n_pass = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first = np.cumsum(n_pass) - n_pass
    total = int(n_pass.sum())
    of = np.repeat(np.arange(len(run)), n_pass)
    passage = first[piece] + rank // PASSAGE_WORDS
    # a passage reaches from its first word to the next passage's; the first one of a piece from the piece's start
    begin = offsets[:-1][of].copy()
    heads = np.flatnonzero((rank % PASSAGE_WORDS == 0) & (rank > 0))
    begin[passage[heads]] = starts[heads]
    length = np.diff(np.append(begin, len(raw)))
    # the line feeds that join the pieces are not part of them; pairs lie within a passage
    length[np.append(first[1:], total) - 1] -= 1
    own = np.ones(len(raw), dtype=bool)
    own[offsets[1:] - 1] = False
    at, seen = np.repeat(np.arange(total), length), raw[own]
    n = np.maximum(length, 1)[:, None]
    codes = np.bincount(at * CODES + CODE[seen], minlength=total * CODES).reshape(total, CODES)
    inside, kind = at[1:] == at[:-1], KIND[seen].astype(np.int64)
    pair = (at[:-1] * (KINDS * KINDS) + kind[:-1] * KINDS + kind[1:])[inside]
    pairs = np.bincount(pair, minlength=total * KINDS * KINDS).reshape(total, KINDS * KINDS)
    lines = codes[:, LINE].copy()

    up, down = POWERS.get(len(raw))
    upper = KIND[raw] == UPPER
    low = raw + np.where(upper, np.uint8(32), np.uint8(0))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
    word = mix64((sums[ends] - sums[starts]) * down[starts])
    uppers = np.concatenate([[0], np.cumsum(upper)])
    size = ends - starts

    def per(weights) -> np.ndarray:
        return np.bincount(passage, weights=weights, minlength=total)

    count = per(np.ones(len(word)))
    some = np.maximum(count, 1)
    both = np.lexsort((word, passage))
    new = np.concatenate([[True], (np.diff(passage[both]) != 0) | (word[both][1:] != word[both][:-1])])[: len(word)]
    same = np.concatenate([[False], (word[1:] == word[:-1]) & (passage[1:] == passage[:-1])])[: len(word)]
    mean = per(size) / some
    shapes = [
        np.log1p(count),
        mean,
        np.sqrt(np.maximum(per(size * size) / some - mean * mean, 0)),
        per(uppers[ends] - uppers[starts] >= np.maximum(2, size * 0.6)) / some,
        per(KIND[raw[ends - 1]] == MARK) / some,
        per(size == 1) / some,
        np.bincount(passage[both], weights=new, minlength=total) / some,
        per(same) / some,
        np.log1p(lines / some * PASSAGE_WORDS),
    ]
    slots = np.bincount(
        passage * WORD_SLOTS + (word >> np.uint64(20)).astype(np.int64) % WORD_SLOTS, minlength=total * WORD_SLOTS
    ).reshape(total, WORD_SLOTS)
    x = np.concatenate(
        [np.sqrt(codes / n), np.sqrt(pairs / n), np.stack(shapes, axis=1), np.sqrt(slots / some[:, None])], axis=1
    )
    return x.astype(np.float32), of


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Attention:
    """Standardisation of descriptions, encoder, gates, and the linear score of the weighted hidden vectors."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.p["E"] + self.p["e"])

    def passages(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Attention logit and share in the score of each passage."""
        h = self.hidden(x)
        gate = np.tanh(h @ self.p["V"]) * _sigmoid(h @ self.p["U"])
        return gate @ self.p["w"], h @ self.p["c"]

    def scores(self, texts) -> np.ndarray:
        """The score of each text: the attention-weighted mean of its passages' shares, through the logistic."""
        logits, shares, ofs = [], [], []
        for run, of in _runs(texts):
            x, piece = describe(run)
            a, g = self.passages(x)
            logits.append(a)
            shares.append(g)
            ofs.append(np.asarray(of)[piece])
        if not ofs:
            return np.zeros(0)
        of = np.concatenate(ofs)
        weight, start = softmax(np.concatenate(logits), of)
        return _sigmoid(np.add.reduceat(weight * np.concatenate(shares), start) + float(self.p["b"][0]))


def softmax(logits: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights that sum to one over each bag of consecutive passages, and the starts of the bags."""
    start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    n = np.diff(np.append(start, len(of)))
    w = np.exp(logits - np.repeat(np.maximum.reduceat(logits, start), n))
    return w / np.repeat(np.add.reduceat(w, start), n), start


def gradient(model: Attention, x: np.ndarray, of: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean logistic loss over bags, by the chain rule."""
    p = model.p
    z = (x - model.mean) / model.scale
    h = np.tanh(z @ p["E"] + p["e"])
    t, q = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    a, start = softmax((t * q) @ p["w"], of)
    n = np.diff(np.append(start, len(of)))
    g = h @ p["c"]
    mid = np.add.reduceat(a * g, start)
    err = (_sigmoid(mid + p["b"][0]) - y) / len(y)
    each = np.repeat(err, n)
    d_logit = each * a * (g - np.repeat(mid, n))
    d_gate = d_logit[:, None] * p["w"]
    d_t, d_q = d_gate * q * (1 - t * t), d_gate * t * q * (1 - q)
    d_h = (each * a)[:, None] * p["c"] + d_t @ p["V"].T + d_q @ p["U"].T
    d_z = d_h * (1 - h * h)
    return {
        "E": z.T @ d_z, "e": d_z.sum(axis=0), "V": h.T @ d_t, "U": h.T @ d_q, "w": (t * q).T @ d_logit,
        "c": h.T @ (each * a), "b": np.array([err.sum()]),
    }


def fit_attention(x: np.ndarray, of: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, ridge: float = 1e-4) -> Attention:
    """Adam over batches of bags; ``of`` is the bag of each passage (consecutive), ``y`` the label of each bag."""
    rng = np.random.default_rng(SEED)
    mean, scale = x.mean(axis=0, dtype=np.float64), x.std(axis=0, dtype=np.float64)
    scale = np.maximum(scale, 1e-3)
    p = {
        "E": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "e": np.zeros(HIDDEN),
        "V": rng.normal(0, 0.3, (HIDDEN, GATES)), "U": rng.normal(0, 0.3, (HIDDEN, GATES)),
        "w": rng.normal(0, 0.3, GATES), "c": rng.normal(0, 0.1, HIDDEN),
        "b": np.array([np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))]),
    }
    model = Attention(mean.astype(np.float32), scale.astype(np.float32), p)
    m, s = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    stop = np.append(start[1:], len(of))
    steps, step = epochs * -(-len(y) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH):
            bags = order[i : i + BATCH]
            rows = np.concatenate([np.arange(start[b], stop[b]) for b in bags])
            grad = gradient(model, x[rows], np.repeat(np.arange(len(bags)), stop[bags] - start[bags]), y[bags])
            step += 1
            rate = 0.01 * (1 - (step - 1) / steps)
            for k, g in grad.items():
                g = g + ridge * p[k] if k != "b" else g
                m[k], s[k] = 0.9 * m[k] + 0.1 * g, 0.99 * s[k] + 0.01 * g * g
                p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)
    return model


def constant(share: float) -> Attention:
    """The model that gives every text the same score."""
    logit = np.log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -30.0)
    p = {"E": np.zeros((WIDTH, HIDDEN)), "e": np.zeros(HIDDEN), "V": np.zeros((HIDDEN, GATES)), "U": np.zeros((HIDDEN, GATES)),
         "w": np.zeros(GATES), "c": np.zeros(HIDDEN), "b": np.array([logit])}
    return Attention(np.zeros(WIDTH, dtype=np.float32), np.ones(WIDTH, dtype=np.float32), p)


def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """At most FIT_PASSAGES descriptions of each labelled text, as bytes."""
    for pdf in batches:
        for text, good, place in zip(pdf["text"], pdf["good"], pdf["place"]):
            x = np.concatenate([describe(run)[0] for run, _ in _runs([text])])
            some = x[np.unique(np.linspace(0, len(x) - 1, min(len(x), FIT_PASSAGES)).round().astype(int))]
            yield pd.DataFrame({"place": [place], "good": [good], "x": [some.tobytes()]})


def fit(docs: DataFrame, labels: DataFrame) -> Attention:
    """The model from the labelled documents of ``docs`` that are not held out."""
    learn = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    learn = keep(learn.groupBy("doc_id").agg(F.max("quality").cast("int").alias("good")), "quality-labels")
    n, n_good = learn.agg(F.count(F.lit(1)), F.coalesce(F.sum("good"), F.lit(0))).first()
    if not 0 < n_good < n:
        return constant(n_good / n if n else 0.0)
    place = F.xxhash64("doc_id", F.lit(SEED))
    # ids first: somewhat more than are wanted by a cut of the hash, the exact bound by its order afterwards
    share = min(1.0, 1.2 * FIT_ROWS / n + 1e-6)
    some = learn.where(F.pmod(place, F.lit(1 << 30)) < int(share * (1 << 30)))
    some = F.broadcast(some) if n * share <= BROADCAST_IDS else some
    found = docs.select("doc_id", "text").join(some, "doc_id").select(place.alias("place"), "good", "text")
    bags = keep(found.mapInPandas(_bags, "place long, good int, x binary"), "quality-bags")
    rows = bags.orderBy("place", "good", "x").limit(FIT_ROWS).collect()
    y = np.array([r["good"] for r in rows], dtype=float)
    if not 0 < y.sum() < len(y):
        return constant(n_good / n)
    x = [np.frombuffer(r["x"], dtype=np.float32).reshape(-1, WIDTH) for r in rows]
    return fit_attention(np.concatenate(x), np.repeat(np.arange(len(x)), [len(b) for b in x]), y)


def _scores(model: Attention):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "score": model.scores(pdf["text"])})

    return run


def quality(docs: DataFrame, labels: DataFrame, good_from: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= ``good_from``) of every row of ``docs``."""
    model = fit(docs, labels)
    ids = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    scored = ids.mapInPandas(_scores(model), "id string, score double")
    doc_id = F.col("id").cast(docs.schema["doc_id"].dataType)
    return scored.select(
        doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "score",
        (F.col("score") >= good_from).cast("int").alias("predicted"),
    )
