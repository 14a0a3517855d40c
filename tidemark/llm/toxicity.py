"""Toxicity: a bidirectional gated recurrent network over overlapping windows.

Each word enters as a word vector and as the mean vector of its known character
pieces (three to five letters, edges marked), so inflected and unseen forms are
read by their letters. A gated recurrent unit runs over each window in both
directions, attention weighs its states, and a logistic unit scores the pooled
state. A text's score is that of its most toxic window, calibrated on training
texts. Everything is numpy.

Labels belong to texts, not windows. Training therefore takes each toxic text's
most suspicious window, and windows of clean texts of which the hardest come
back each round.

The model is fitted on the driver on a bounded sample of labelled rows
(``Settings.toxic_rows`` and ``clean_rows``, texts of at most ``longest_text``
characters, words and pieces at most ``words`` and ``pieces``). Every text,
whatever its length, is scored whole, in tasks, a bounded number of windows at
a time.

Defined cases: null and empty texts score as a window without known words;
texts shorter than a window are padded and the padding is masked; without
labels of both kinds every text scores 0; null labels are left out, of several
labels of one id the largest counts; rows of the input stay one to one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LONG_ROWS, in_slices, stored

HELD_OUT = 2
FOLDS = 4
THRESHOLD = 0.3
BROADCAST_TEXTS = 2_000_000
CACHED_WORDS = 120_000
CHUNK = 2048
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Settings:
    toxic_rows: int = 1200
    clean_rows: int = 1800
    longest_text: int = 200_000
    words: int = 2000
    pieces: int = 4000
    per_word: int = 6
    window: int = 32
    stride: int = 24
    word_size: int = 6
    piece_size: int = 6
    hidden: int = 10
    rounds: int = 10
    clean_windows: int = 6000
    rate: float = 0.01
    seed: int = 7


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def pieces(word: str) -> set[str]:
    edged = f"^{word}$"
    return {edged[i:i + n] for n in (3, 4, 5) for i in range(len(edged) - n + 1)}


def window_starts(n: int, window: int, stride: int) -> list[int]:
    """Starts of overlapping windows that cover ``n`` words; the last ends with the text."""
    if n <= window:
        return [0]
    return [*range(0, n - window, stride), n - window]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Vocabularies (word or piece to row) and weights. Row 0 stands for none."""

    settings: Settings
    word_rows: dict[str, int]
    piece_rows: dict[str, int]
    weights: dict[str, np.ndarray]
    slope: float = 1.0
    offset: float = 0.0
    cache: dict[str, int] = field(default_factory=dict)
    gates: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "cache": {}, "gates": None}

    def word_input(self, word: str) -> tuple[int, list[int]]:
        found = sorted(self.piece_rows[p] for p in pieces(word) if p in self.piece_rows)
        return self.word_rows.get(word, 0), found[:self.settings.per_word]

    def gate_rows(self, words: list[str]) -> np.ndarray:
        """Rows of ``self.gates`` for the words; row 0 is the padding."""
        missing = [w for w in dict.fromkeys(words) if w not in self.cache]
        if self.gates is None or len(self.cache) + len(missing) > CACHED_WORDS:
            self.cache, self.gates = {"": 0}, self.input_gates([0], [[]])
            missing = list(dict.fromkeys(words))
        if missing:
            inputs = [self.word_input(w) for w in missing]
            first = len(self.cache)
            if len(self.gates) < first + len(missing):
                self.gates = np.concatenate([self.gates, np.zeros((max(len(self.gates), len(missing), 1024), self.gates.shape[1]), np.float32)])
            self.gates[first:first + len(missing)] = self.input_gates([i[0] for i in inputs], [i[1] for i in inputs])
            self.cache.update(zip(missing, range(first, first + len(missing))))
        return np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))

    def input_gates(self, word_rows: list[int], piece_rows: list[list[int]]) -> np.ndarray:
        w = self.weights
        x, _, _ = mean_inputs(w, np.array(word_rows), padded(piece_rows, self.settings.per_word))
        return (x @ w["in"] + w["in_bias"]).astype(np.float32)

    def window_logits(self, rows: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Logits of windows given as gate rows [windows, window]."""
        out = [run_network(self.weights, self.gates[rows[i:i + CHUNK]].transpose(1, 0, 2), mask[i:i + CHUNK].T)["logit"] for i in range(0, len(rows), CHUNK)]
        return np.concatenate(out) if out else np.zeros(0, np.float32)

    def windows_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        s = self.settings
        rows = self.gate_rows(words)
        if len(rows) < s.window:
            rows, real = np.concatenate([rows, np.zeros(s.window - len(rows), np.int64)]), len(rows)
            return rows[None, :], (np.arange(s.window) < max(real, 1))[None, :]
        at = np.array(window_starts(len(rows), s.window, s.stride))[:, None] + np.arange(s.window)
        return rows[at], np.ones(at.shape, bool)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Score of each whole text. Windows of several texts share a pass; a long
        text's windows take several."""
        best = np.full(len(texts), -np.inf)
        waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
        held = 0

        def flush() -> None:
            if waiting:
                logits = self.window_logits(np.concatenate([w[1] for w in waiting]), np.concatenate([w[2] for w in waiting]))
                np.maximum.at(best, np.repeat([w[0] for w in waiting], [len(w[1]) for w in waiting]), logits)
                waiting.clear()

        for i, text in enumerate(texts):
            words = tokens(text)
            if len(self.cache) + len(words) > CACHED_WORDS and held:
                flush()
                held = 0
            for begin in range(0, max(1, len(words)), CACHED_WORDS // 2):
                # parts of a huge text overlap by a window, so each window is whole in one of them
                part = words[max(0, begin - self.settings.window):begin + CACHED_WORDS // 2]
                rows, mask = self.windows_of(part)
                waiting.append((i, rows, mask))
                held += len(rows)
                if held > 4 * CHUNK or len(words) > CACHED_WORDS // 2:
                    flush()
                    held = 0
        flush()
        return _sigmoid(self.slope * best + self.offset)


def padded(lists: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, found in enumerate(lists):
        out[i, :len(found)] = found
    return out


def mean_inputs(w: dict, word_rows: np.ndarray, piece_rows: np.ndarray):
    known = (piece_rows > 0).astype(np.float32)
    share = known / np.maximum(known.sum(-1, keepdims=True), 1)
    letters = (w["pieces"][piece_rows] * share[..., None]).sum(-2)
    return np.concatenate([w["words"][word_rows], letters], -1), share, known


def _direction(gates: np.ndarray, mask: np.ndarray | None, u: np.ndarray, keep: list | None) -> np.ndarray:
    """States [window, batch, hidden] of one direction, given input gates in its order."""
    steps, batch, h3 = gates.shape
    h = h3 // 3
    state = np.zeros((batch, h), np.float32)
    out = np.empty((steps, batch, h), np.float32)
    for t in range(steps):
        back = state @ u
        zr = 1 / (1 + np.exp(-(gates[t, :, :2 * h] + back[:, :2 * h])))
        z, r = zr[:, :h], zr[:, h:]
        new = np.tanh(gates[t, :, 2 * h:] + r * back[:, 2 * h:])
        next_ = new + z * (state - new)
        if mask is not None:
            next_ = np.where(mask[t][:, None], next_, state)
        if keep is not None:
            keep.append((state, z, r, new, back[:, 2 * h:]))
        state = out[t] = next_
    return out


def run_network(w: dict, gates: np.ndarray, mask: np.ndarray, keep: bool = False) -> dict:
    """Forward pass over [window, batch, 6 * hidden] input gates."""
    h3 = gates.shape[2] // 2
    masks = None if mask.all() else mask
    kept_f, kept_b = ([], []) if keep else (None, None)
    ahead = _direction(gates[:, :, :h3], masks, w["ahead"], kept_f)
    behind = _direction(gates[::-1, :, h3:], None if masks is None else masks[::-1], w["behind"], kept_b)[::-1]
    states = np.concatenate([ahead, behind], -1)
    heed = states @ w["heed"]
    heed = np.where(mask, heed, -1e9)
    heed = np.exp(heed - heed.max(0))
    heed /= heed.sum(0)
    pooled = (heed[:, :, None] * states).sum(0)
    return {"logit": pooled @ w["out"] + w["out_bias"][0], "states": states, "heed": heed, "pooled": pooled, "kept": (kept_f, kept_b)}


def _direction_gradient(d_out: np.ndarray, mask: np.ndarray, kept: list, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps, batch, h = d_out.shape
    d_gates, d_u = np.zeros((steps, batch, 3 * h), np.float32), np.zeros_like(u)
    d_state = np.zeros((batch, h), np.float32)
    for t in range(steps - 1, -1, -1):
        state, z, r, new, back_n = kept[t]
        d = d_state + d_out[t]
        on = mask[t][:, None]
        d_on = np.where(on, d, 0)
        d_pre = d_on * (1 - z) * (1 - new * new)
        d_z = d_on * (state - new) * z * (1 - z)
        d_r = d_pre * back_n * r * (1 - r)
        d_gates[t] = np.concatenate([d_z, d_r, d_pre], 1)
        d_back = np.concatenate([d_z, d_r, d_pre * r], 1)
        d_u += state.T @ d_back
        d_state = d_on * z + d_back @ u.T + np.where(on, 0, d)
    return d_gates, d_u


def gradients(w: dict, word_rows: np.ndarray, piece_rows: np.ndarray, mask: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
    """Weighted log loss of a batch of windows [batch, window] and its gradients."""
    x, share, _ = mean_inputs(w, word_rows, piece_rows)
    gates = (x @ w["in"] + w["in_bias"]).transpose(1, 0, 2).astype(np.float32)
    m = mask.T
    f = run_network(w, gates, m, keep=True)
    p = _sigmoid(f["logit"])
    loss = -np.mean(weight * (labels * np.log(p + 1e-9) + (1 - labels) * np.log(1 - p + 1e-9)))
    d_logit = (weight * (p - labels) / len(labels)).astype(np.float32)
    d_pooled = d_logit[:, None] * w["out"]
    d_heed = (f["states"] * d_pooled).sum(-1)
    d_score = f["heed"] * (d_heed - (f["heed"] * d_heed).sum(0))
    d_states = f["heed"][:, :, None] * d_pooled + d_score[:, :, None] * w["heed"]
    h = len(w["ahead"])
    d_f, d_uf = _direction_gradient(d_states[:, :, :h], m, f["kept"][0], w["ahead"])
    d_b, d_ub = _direction_gradient(d_states[::-1, :, h:], m[::-1], f["kept"][1], w["behind"])
    d_gates = np.concatenate([d_f, d_b[::-1]], -1).transpose(1, 0, 2)
    flat = d_gates.reshape(-1, d_gates.shape[-1])
    d_x = d_gates @ w["in"].T
    size = w["words"].shape[1]
    d_words, d_pieces = np.zeros_like(w["words"]), np.zeros_like(w["pieces"])
    np.add.at(d_words, word_rows.ravel(), d_x[..., :size].reshape(-1, size))
    np.add.at(d_pieces, piece_rows.ravel(), (d_x[..., None, size:] * share[..., None]).reshape(-1, w["pieces"].shape[1]))
    return float(loss), {
        "words": d_words, "pieces": d_pieces, "in": x.reshape(-1, x.shape[-1]).T @ flat, "in_bias": flat.sum(0), "ahead": d_uf, "behind": d_ub,
        "heed": (d_score[:, :, None] * f["states"]).sum((0, 1)), "out": f["pooled"].T @ d_logit, "out_bias": np.array([d_logit.sum()], np.float32),
    }


def associated(features: list[np.ndarray], names: list[str], labels: np.ndarray, most: int) -> dict[str, float]:
    """Names of the features whose share among toxic texts is highest compared to
    clean ones, with their log odds. ``features`` are the distinct numbers of each text."""
    counts = np.zeros((2, len(names)))
    for found, label in zip(features, labels):
        counts[int(label), found] += 1
    n1, n0 = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    b, a = counts
    share = (a + b) / (n1 + n0)
    z = (a / n1 - b / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    odds = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
    kept = np.flatnonzero((a + b >= 5) & (z > 2.5)).tolist()
    kept.sort(key=lambda k: (-z[k], names[k]))
    return {names[k]: float(odds[k]) for k in kept[:most]}


def numbered(words: list[str]) -> tuple[list[str], list[np.ndarray]]:
    """All pieces of the words, and the numbers of each word's."""
    known: dict[str, int] = {}
    rows = [np.array([known.setdefault(p, len(known)) for p in sorted(pieces(w))], np.int32) for w in words]
    return list(known), rows


def train(texts: list[str], labels: list[int], settings: Settings = Settings()) -> Model:
    """Fits the network to labelled texts. Words are numbers from the start, so
    memory is that of the sample's distinct words and pieces."""
    s, y = settings, np.array(labels, np.int64)
    rng = np.random.default_rng(s.seed)
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w, len(number) + 1) for w in tokens(t)], np.int32) for t in texts]
    names = list(number)
    sets = [np.unique(d) - 1 for d in docs]
    word_odds = associated(sets, names, y, s.words)
    piece_names, held = numbered(names)
    piece_sets = [np.unique(np.concatenate([held[k] for k in found])) if len(found) else np.zeros(0, np.int32) for found in sets]
    piece_odds = associated(piece_sets, piece_names, y, s.pieces)
    del piece_names, held, piece_sets, sets
    model = Model(s, {w: i + 1 for i, w in enumerate(word_odds)}, {p: i + 1 for i, p in enumerate(piece_odds)}, {})
    h, dim = s.hidden, s.word_size + s.piece_size

    def scaled(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    w = model.weights = {
        "words": 0.1 * rng.standard_normal((len(word_odds) + 1, s.word_size)).astype(np.float32),
        "pieces": 0.1 * rng.standard_normal((len(piece_odds) + 1, s.piece_size)).astype(np.float32),
        "in": scaled(dim, 6 * h), "in_bias": np.zeros(6 * h, np.float32), "ahead": scaled(h, 3 * h), "behind": scaled(h, 3 * h),
        "heed": scaled(2 * h), "out": scaled(2 * h), "out_bias": np.array([-1.0], np.float32),
    }
    w["words"][1:, 0], w["pieces"][1:, 0] = list(word_odds.values()), list(piece_odds.values())
    w["words"][0], w["pieces"][0] = 0, 0
    if not len(y) or y.min() == y.max():
        model.slope, model.offset = 0.0, -30.0
        return model

    word_of, piece_of = np.zeros(len(names) + 1, np.int32), np.zeros((len(names) + 1, s.per_word), np.int32)
    for k, name in enumerate(names):
        word_of[k + 1], found = model.word_input(name)
        piece_of[k + 1, :len(found)] = found
    values = np.concatenate([[0], list(piece_odds.values())])
    odds = np.maximum(np.concatenate([[0], list(word_odds.values())])[word_of], values[piece_of].max(1) / 2)
    windows, masks, owner = [], [], []
    for i, rows in enumerate(docs):
        real = len(rows)
        rows = np.concatenate([rows, np.zeros(max(0, s.window - real), np.int32)])
        for a in window_starts(real, s.window, s.stride):
            windows.append(rows[a:a + s.window])
            masks.append(np.arange(s.window) < max(1, real))
            owner.append(i)
    del docs, names, number
    windows, masks, owner = np.array(windows), np.array(masks), np.array(owner)
    suspicion = odds[windows].max(1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    step = 0

    def logits() -> np.ndarray:
        parts = [mean_inputs(w, word_of[i:i + 20_000], piece_of[i:i + 20_000])[0] for i in range(0, len(word_of), 20_000)]
        gates = np.concatenate([(x @ w["in"] + w["in_bias"]).astype(np.float32) for x in parts])
        return np.concatenate([run_network(w, gates[windows[i:i + CHUNK]].transpose(1, 0, 2), masks[i:i + CHUNK].T)["logit"] for i in range(0, len(windows), CHUNK)])

    clean = np.flatnonzero(y[owner] == 0)
    for turn in range(s.rounds):
        if turn in (4, 8):
            suspicion = logits()
        order = np.lexsort((-suspicion, owner))
        tops = order[np.r_[True, owner[order][1:] != owner[order][:-1]]]
        toxic = tops[y[owner[tops]] == 1]
        hard = clean[np.argsort(-suspicion[clean], kind="stable")[:s.clean_windows // 2]]
        chosen = np.concatenate([toxic, hard, rng.choice(clean, min(len(clean), s.clean_windows // 2), replace=False)])
        chosen = chosen[rng.permutation(len(chosen))]
        for i in range(0, len(chosen), 256):
            b = chosen[i:i + 256]
            target = y[owner[b]].astype(np.float32)
            _, grads = gradients(w, word_of[windows[b]], piece_of[windows[b]], masks[b], target, np.where(target == 1, 2.0, 1.0).astype(np.float32))
            step += 1
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w[k] -= (s.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            w["words"][0], w["pieces"][0] = 0, 0
    best = np.full(len(y), -np.inf)
    np.maximum.at(best, owner, logits())
    model.slope, model.offset = calibrated(best, y)
    return model


def calibrated(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the label to a text's largest logit (ridge on the slope)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * logit + b)
        g = np.array([((p - y) * logit).sum() + 0.1 * (a - 1), (p - y).sum() + 0.1 * b])
        q = p * (1 - p)
        hessian = np.array([[(q * logit * logit).sum() + 0.1, (q * logit).sum()], [(q * logit).sum(), q.sum() + 0.1]])
        move = np.linalg.solve(hessian, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -2, 2)
    return float(max(a, 0.05)), float(b)


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def training_rows(documents: DataFrame, labels: DataFrame, settings: Settings) -> list:
    """The bounded sample: per label the first ids in a seeded order, held-out ids never."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    seeded = F.xxhash64("doc_id", F.lit(settings.seed))
    # twice as many ids as rows: some texts may be missing or too long
    ids = [marked.where(F.col("toxic") == k).orderBy(seeded, "doc_id").limit(2 * n) for k, n in ((1, settings.toxic_rows), (0, settings.clean_rows))]
    chosen = ids[0].unionByName(ids[1])
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= settings.longest_text))
    found = texts.join(F.broadcast(chosen), "doc_id")
    parts = [found.where(F.col("toxic") == k).orderBy(seeded, "doc_id", "text").limit(n) for k, n in ((1, settings.toxic_rows), (0, settings.clean_rows))]
    return parts[0].unionByName(parts[1]).collect()


def fitted(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Trains on the sample. As it holds more toxic rows than the labels do, the
    calibration is moved to the labels' own odds."""
    rows = sorted(training_rows(documents, labels, settings), key=lambda r: (r["doc_id"], r["text"]))
    model = train([r["text"] for r in rows], [int(r["toxic"]) for r in rows], settings)
    usable = labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    toxic, clean = usable.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    held = sum(r["toxic"] for r in rows)
    if 0 < held < len(rows):
        model.offset += float(np.log(toxic / clean) - np.log(held / (len(rows) - held)))
    return model


def scored(documents: DataFrame, model: Model, keep: list[Column] | None = None) -> DataFrame:
    """Rows (row, score): what to ``keep`` of the input's row (all) as one struct, so that
    no name can clash, and its text's score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["row", "score"])

    rows = documents.select(F.struct(*(keep or documents.columns)).alias("row"), "text")
    return rows.mapInArrow(in_slices(run), T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def judged(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = fitted(documents, labels, settings)
    rows = scored(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select("row.doc_id", "score")
    return rows.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows whose text is not predicted toxic, all columns as they came. A score depends
    on the text alone, so only two hashes of each toxic text come back from Python."""
    model = fitted(documents, labels, settings)
    keys = [F.xxhash64("text").alias("first_key"), F.xxhash64(F.lit(1), "text").alias("second_key")]
    texts = scored(documents.select("text"), model, [*keys]).where(F.col("score") >= THRESHOLD)
    toxic = stored(texts.select("row.first_key", "row.second_key").distinct(), "toxic-texts", LONG_ROWS)
    # 16 bytes a text; more of them than this are joined by a shuffle instead.
    toxic = F.broadcast(toxic) if toxic.count() <= BROADCAST_TEXTS else toxic
    rows = documents.select(F.struct(*documents.columns).alias("row"), *keys)
    return rows.join(toxic, ["first_key", "second_key"], "left_anti").select("row.*")
