"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

1. Lexicon voters are words and word beginnings (four to eight bytes, with more to follow) that are frequent in toxic and rare in
   clean labelled documents outside of the held-out fold; pattern voters are surface signs (shouting, stretched
   letters and the like). Each votes "toxic" or abstains.
2. The label model is generative: a hidden class, and voters that vote at rates that depend on it. Expectation
   maximisation over the votes of all documents (grouped by equal votes; labelled rows outside of the held-out
   fold keep their class, all others are weighed by their posterior) estimates each voter's accuracy. The joint
   votes given the class estimate correlations; voters that are correlated and alike in strength are merged into
   one that votes when any of them does, and the model is fitted again. Abstaining beside voters that vote is no
   evidence (the lexicon covers several languages); that nobody votes is an event with rates of its own. Each round sums at most MAX_VOTERS squared
   numbers per class by Spark.
3. A logistic classifier over hashed words, word beginnings and votes is trained on the posteriors of a bounded
   sample (FIT_ROWS documents in hash order, none held out) and scores every whole text.

Labels are read from rows whose crc32(doc_id as text) mod 5 is not 0, for the lexicon (at most LABEL_ROWS rows)
and the class balance. Scores see nothing but the text.

Cases: null and empty texts score the classifier's floor; without labels of both classes there are no voters
and every score is the class balance (0 without any label); repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep
from .shingles import POWERS, RUN_BYTES, mix64

#: Documented bounds: labelled rows that the lexicon is taken from, rows the classifier is fitted on.
LABEL_ROWS, FIT_ROWS = 60_000, 8_000
MAX_LEXICON, MAX_CANDIDATES, MIN_SUPPORT, MIN_PRECISION = 48, 4096, 4, 0.95
PREFIXES = (4, 5, 6, 7, 8)  # bytes
SLOT_PREFIXES = (0, 6)  # whole words and beginnings of six bytes are features
SLOTS = 1 << 15
PATTERNS = ("shouting", "exclaiming", "stretched", "numbers", "repeating")
MAX_VOTERS = MAX_LEXICON + len(PATTERNS)
TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _bytes(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def _terms(text: bytes) -> set[bytes]:
    """Distinct lower-case words and word beginnings (marked by a final star)."""
    words = {w.lower() for w in TOKEN.findall(text)}
    return words | {w[:k] + b"*" for w in words for k in PREFIXES if len(w) > k}


def _count_terms(only: frozenset[bytes] | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: Counter = Counter()
            for text in pdf["text"]:
                found = _terms(_bytes(text))
                seen.update(found if only is None else found & only)
            yield pd.DataFrame({"term": list(seen.keys()), "n": list(seen.values())})

    return run


def lexicon(train: DataFrame, n_toxic: int, n_clean: int) -> list[bytes]:
    """Terms of ``train`` (text, toxic) by their number of toxic documents, if precise enough at equal classes."""
    toxic = train.where("toxic = 1").select("text").mapInPandas(_count_terms(None), "term binary, n long")
    toxic = toxic.groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_SUPPORT)
    rows = toxic.orderBy(F.col("n").desc(), "term").limit(MAX_CANDIDATES).collect()
    hits = {bytes(r["term"]): r["n"] for r in rows}
    clean = train.where("toxic = 0").select("text").mapInPandas(_count_terms(frozenset(hits)), "term binary, n long")
    misses = {bytes(r["term"]): r["n"] for r in clean.groupBy("term").agg(F.sum("n").alias("n")).collect()}

    def precision(t: bytes) -> float:
        p, q = hits[t] / n_toxic, (misses.get(t, 0) + 0.5) / n_clean
        return p / (p + q)

    chosen: list[bytes] = []
    for t in sorted((t for t in hits if precision(t) >= MIN_PRECISION), key=lambda t: (-hits[t] * (2 * precision(t) - 1), t)):
        # a word (or longer beginning) adds nothing to a beginning of it that is as precise
        if not any(c.endswith(b"*") and t.startswith(c[:-1]) and precision(c) >= precision(t) - 0.01 for c in chosen):
            chosen.append(t)
        if len(chosen) == MAX_LEXICON:
            break
    return chosen


def _hash(piece: bytes, kind: int) -> int:
    """The hash that _pieces gives to a word (kind 0) or a beginning of ``kind`` bytes."""
    up, _ = POWERS.get(len(piece) + 1)
    value = np.frombuffer(piece, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    total = (value * up[: len(piece)]).sum(dtype=np.uint64)
    return int(mix64(np.array([total], dtype=np.uint64) + np.uint64(kind))[0])


def _pieces(texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashes of all words and of all beginnings of each length of a run of texts, and the text of each."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    upper = (raw >= 65) & (raw <= 90)
    low = raw + np.where(upper, np.uint8(32), np.uint8(0))
    letter = ((low >= 97) & (low <= 122)) | (low >= 128)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], letter]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = POWERS.get(len(raw))
    value = low.astype(np.uint64) + np.uint64(1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(value * up, dtype=np.uint64)])
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    of = np.searchsorted(offsets, starts, side="right") - 1
    hashes, at = [mix64((sums[ends] - sums[starts]) * down[starts])], [of]
    for k in PREFIXES:
        longer = ends - starts > k
        s = starts[longer]
        hashes.append(mix64((sums[s + k] - sums[s]) * down[s] + np.uint64(k)))
        at.append(of[longer])
    return hashes, at


def _signs(text: bytes) -> list[bool]:
    """Votes of the pattern voters."""
    letters = sum(map(len, TOKEN.findall(text))) or 1
    upper = len(re.findall(rb"[A-Z]", text))
    return [
        letters > 20 and upper > 0.3 * letters,
        text.count(b"!") >= 3,
        re.search(rb"([a-z])\1{3}", text) is not None,
        len(re.findall(rb"[0-9]", text)) > 0.2 * max(len(text), 1),
        re.search(rb"\b([A-Za-z]{3,}) \1 \1\b", text) is not None,
    ]


@dataclass
class Voters:
    names: list[bytes]

    def __post_init__(self):
        kinds = [(t[:-1], len(t) - 1) if t.endswith(b"*") else (t, 0) for t in self.names]
        hashes = np.array([_hash(*k) for k in kinds], dtype=np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def read(self, texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its votes (0/1 by voter) and its distinct feature slots."""
        run, size = [], 0
        for t in texts:
            run.append(_bytes(t))
            size += len(run[-1])
            if size >= RUN_BYTES:
                yield from self._read(run)
                run, size = [], 0
        if run:
            yield from self._read(run)

    def _read(self, run: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        hashes, ats = _pieces(run)
        votes = np.zeros((len(run), len(self.names) + len(PATTERNS)), dtype=np.int64)
        for h, at in zip(hashes, ats) if len(self.names) else []:
            pos = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[pos] == h
            votes[at[hit], self.order[pos[hit]]] = 1
        used = [(0, *PREFIXES).index(k) for k in SLOT_PREFIXES]
        h, at = np.concatenate([hashes[k] for k in used]), np.concatenate([ats[k] for k in used])
        slots = (h >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)
        both = np.unique(at.astype(np.int64) * SLOTS + slots)
        cut = np.searchsorted(both, np.arange(len(run) + 1) * SLOTS)
        for i, t in enumerate(run):
            votes[i, len(self.names) :] = _signs(t)
            yield votes[i], both[cut[i] : cut[i + 1]] & (SLOTS - 1)


def _masks(voters: Voters):
    """The votes of each text as the bits of a long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bits = [int((v << np.arange(len(v))).sum()) for v, _ in voters.read(pdf["text"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "mask": bits})

    return run


@dataclass
class LabelModel:
    """Merged voters (groups of voter numbers), their vote rates given toxic and given clean, their correlations
    given toxic, and the class balance."""

    groups: list[list[int]]
    toxic: np.ndarray
    clean: np.ndarray
    related: np.ndarray
    balance: float
    silent: tuple[float, float] = (0.5, 0.5)  # rate of no vote at all given toxic, given clean

    def merged(self, votes: np.ndarray) -> np.ndarray:
        return np.stack([votes[:, g].max(axis=1) for g in self.groups], axis=1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        m = self.merged(votes)
        logit = np.log(self.balance / (1 - self.balance)) + m @ np.log(self.toxic / self.clean)
        logit = logit + np.where(m.any(axis=1), 0.0, np.log(self.silent[0] / self.silent[1]))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _expect(model: LabelModel, n_voters: int, labelled_only: bool):
    """Per task: joint votes of merged voters given toxic and given clean, and the weights of the classes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            votes = (pdf["mask"].to_numpy(dtype=np.int64)[:, None] >> np.arange(n_voters)) & 1
            toxic, n = pdf["toxic"].to_numpy(dtype=float), pdf["n"].to_numpy(dtype=float)
            known = ~np.isnan(toxic)
            p = np.where(known, np.nan_to_num(toxic), 0.0 if labelled_only else model.posterior(votes))
            keep_it = known if labelled_only else np.ones(len(n), dtype=bool)
            m = model.merged(votes)[keep_it].astype(float)
            w1, w0 = (n * p)[keep_it], (n * (1 - p))[keep_it]
            quiet = ~m.any(axis=1)
            flat = np.concatenate([[w1.sum(), w0.sum(), w1[quiet].sum(), w0[quiet].sum()], (m.T @ (m * w1[:, None])).ravel(), (m.T @ (m * w0[:, None])).ravel()])
            total = flat if total is None else total + flat
        if total is not None:
            yield pd.DataFrame({"at": np.arange(len(total)), "v": total})

    return run


def _refit(grouped: DataFrame, model: LabelModel, n_voters: int, labelled_only: bool = False) -> LabelModel:
    rows = grouped.mapInPandas(_expect(model, n_voters, labelled_only), "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
    g = len(model.groups)
    flat = np.zeros(4 + 2 * g * g)
    for r in rows.collect():
        flat[r["at"]] = r["v"]
    n1, n0 = max(flat[0], 1e-9), max(flat[1], 1e-9)
    both = flat[4 : 4 + g * g].reshape(g, g) / n1
    toxic = (np.diag(both) * n1 + 0.5) / (n1 + 1)
    clean = (flat[4 + g * g :].reshape(g, g).diagonal() + 0.5) / (n0 + 1)
    spread = np.sqrt(np.maximum(toxic * (1 - toxic), 1e-12))
    related = (both - np.outer(toxic, toxic)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    silent = ((flat[2] + 0.5) / (n1 + 1), (flat[3] + 0.5) / (n0 + 1))
    return LabelModel(model.groups, toxic, clean, related, n1 / (n1 + n0), silent)


def _merge(model: LabelModel, correlated: float = 0.3, alike: float = 2.5) -> LabelModel:
    """Voters joined that are correlated given toxic and alike in strength."""
    strength = np.log(model.toxic / model.clean)
    near = (model.related > correlated) & (np.abs(strength[:, None] - strength[None, :]) < alike)
    low = np.arange(len(strength))
    while True:
        new = np.array([min([low[i], *low[near[i]]]) for i in range(len(low))])
        if (new == low).all():
            break
        low = new
    groups = [[v for i in np.flatnonzero(low == k) for v in model.groups[i]] for k in np.unique(low)]
    blank = np.full(len(groups), 0.5)
    return LabelModel(groups, blank, blank, np.zeros((len(groups),) * 2), model.balance)


def fit_label_model(grouped: DataFrame, n_voters: int, rounds: int = 3) -> LabelModel:
    """From (mask, toxic or null, n): equal votes and their number of documents."""
    half = np.full(n_voters, 0.5)
    model = LabelModel([[i] for i in range(n_voters)], half, half, np.zeros((n_voters, n_voters)), 0.5)
    model = _merge(_refit(grouped, _refit(grouped, model, n_voters, labelled_only=True), n_voters))
    model = _refit(grouped, model, n_voters, labelled_only=True)
    for _ in range(rounds):
        model = _refit(grouped, model, n_voters)
    return model


def _features(voters: Voters):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = list(voters.read(pdf["text"]))
            yield pd.DataFrame({"votes": [v for v, _ in rows], "slots": [s for _, s in rows]})

    return run


@dataclass
class Classifier:
    slots: np.ndarray
    votes: np.ndarray
    bias: float

    def score(self, votes: np.ndarray, slots: np.ndarray) -> float:
        z = self.bias + float(self.votes @ votes) + float(self.slots[slots].sum()) / np.sqrt(max(len(slots), 1))
        return float(1 / (1 + np.exp(-min(max(z, -30), 30))))


def fit_classifier(votes: np.ndarray, slots: list[np.ndarray], target: np.ndarray, steps: int = 200, ridge: float = 2e-3) -> Classifier:
    """Logistic regression on soft targets by full-batch Adam; the hashed slots are held back by the ridge."""
    n = len(target)
    at = np.repeat(np.arange(n), [len(s) for s in slots])
    col = np.concatenate(slots).astype(np.int64) if n else np.zeros(0, dtype=np.int64)
    value = (1 / np.sqrt(np.maximum([len(s) for s in slots], 1)))[at] if n else np.zeros(0)
    # both classes weigh the same
    mass = np.array([max((1 - target).sum(), 1e-9), max(target.sum(), 1e-9)])
    weight = (target * (mass.sum() / (2 * mass[1])) + (1 - target) * (mass.sum() / (2 * mass[0]))) / max(n, 1)
    w = np.zeros(SLOTS + votes.shape[1] + 1)
    m, s = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = np.bincount(at, weights=w[col] * value, minlength=n) + votes @ w[SLOTS:-1] + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight
        g = np.concatenate([np.bincount(col, weights=err[at] * value, minlength=SLOTS), votes.T @ err, [err.sum()]])
        g[:SLOTS] += ridge * w[:SLOTS]
        g[SLOTS:-1] += 1e-5 * w[SLOTS:-1]
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        rate = 0.15 * (1 - step / (steps + 1))
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Classifier(w[:SLOTS], w[SLOTS:-1], float(w[-1]))


def _scores(voters: Voters, model: Classifier, rows: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({rows: pdf[rows], "score": [model.score(v, s) for v, s in voters.read(pdf["text"])]})

    return run


@dataclass
class Fitted:
    voters: Voters
    labels: LabelModel | None
    model: Classifier


def fit(docs: DataFrame, labels: DataFrame) -> Fitted:
    """Lexicon from labelled rows, label model from all of ``docs``, classifier from the bounded sample."""
    learn = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    learn = keep(learn.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-labels")
    n, n_toxic = learn.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    balance = n_toxic / n if n else 0.0
    if not 0 < n_toxic < n:
        z = np.log(balance / (1 - balance)) if 0 < balance < 1 else (30.0 if balance else -30.0)
        return Fitted(Voters([]), None, Classifier(np.zeros(SLOTS), np.zeros(len(PATTERNS)), float(z)))
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(1 << 20))
    some = learn.where(part < F.lit(int((1 << 20) * min(1.0, LABEL_ROWS / n)) or 1))
    few = n <= 1_000_000
    train = keep(docs.select("doc_id", "text").join(F.broadcast(some) if few else some, "doc_id").select("text", "toxic"), "toxic-train")
    n_train, tox_train = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    words = lexicon(train, tox_train, n_train - tox_train) if 0 < tox_train < n_train else []
    voters = Voters(words)
    v = len(words) + len(PATTERNS)
    ids = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    votes = ids.mapInPandas(_masks(voters), "doc_id string, mask long")
    known = learn.select(F.col("doc_id").cast("string").alias("doc_id"), "toxic")
    grouped = votes.join(F.broadcast(known) if few else known, "doc_id", "left").groupBy("mask", "toxic")
    grouped = keep(grouped.agg(F.count(F.lit(1)).alias("n")), "toxic-votes")
    total = grouped.agg(F.sum("n")).first()[0] or 0
    label_model = fit_label_model(grouped, v)
    sample = docs.where(~held_out(F.col("doc_id"))).where(part < F.lit(int((1 << 20) * min(1.0, FIT_ROWS / max(total, 1))) or 1))
    rows = sample.select("text").mapInPandas(_features(voters), "votes array<int>, slots array<int>").toPandas()
    votes = np.array(rows["votes"].tolist(), dtype=float).reshape(len(rows), v)
    model = fit_classifier(votes, [np.asarray(s) for s in rows["slots"]], label_model.posterior(votes))
    return Fitted(voters, label_model, model)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= 0.5) of every row of ``docs``."""
    fitted = fit(docs, labels)
    ids = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    scored = ids.mapInPandas(_scores(fitted.voters, fitted.model, "id"), "id string, score double")
    doc_id = F.col("id").cast(docs.schema["doc_id"].dataType)
    return scored.select(
        doc_id.alias("doc_id"),
        held_out(doc_id).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier predicts toxic; columns as they are."""
    fitted = fit(docs, labels)
    score = _score_column(fitted)
    return docs.where(score(F.col("text")) < 0.5)


def _score_column(fitted: Fitted):
    voters, model = fitted.voters, fitted.model

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([model.score(v, s) for v, s in voters.read(text)], dtype="float64")

    return score
