"""Subject areas of documents (problem 8).

1. Terms: a naive Bayes model over the terms of sentences, with one class per subject and one for sentences of no
   subject, is fitted to documents whose subjects are known. Which sentence of a document deals with which of its subjects
   is hidden; expectation maximisation finds it, within the document's reviewed subjects and the class of no subject, with a
   small weight for the other subjects, as documents mention subjects in passing and some reviews are wrong.
2. Features of a document: the share of its sentences per subject, its source, and its structure (sentences, list items,
   length of the sentences).
3. A classifier chain: one logistic regression per subject, in order of frequency, over those features, the decisions for
   the subjects before it, and nothing else; each is calibrated on documents that it did not see.
4. Decoding: beam search along the chain for the most probable combination of subjects.

Training uses at most ``MAX_LABELLED`` documents with reviewed subjects (a seeded sample beyond); everything else covers all
documents. The model holds every term that two of those documents share; the sample bounds its size, so it is broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import spread

#: Labelled documents used for training, and beam width.
MAX_LABELLED = 6_000
BEAM = 6
SEED = 17

_ROUNDS = 12
_PASSING = 1e-4  # weight of subjects outside a document's reviewed ones; more lets a rare subject collect what fits none
_SENTENCES_COUNTED = 10
_LIFT = 2.0
_SMOOTH = 60.0  # terms of the mean class added to each class, so that a rare class doesn't claim unseen terms

_WORD = re.compile(r"[^\W\d_]+")
_CJK = re.compile(r"[⺀-鿿豈-﫿]+")
_SPLIT = re.compile(r"(?<=[。！])|(?<=[.!])\s+")


def sentences(text: str) -> list[tuple[str, bool]]:
    """Sentences of a text, each with whether it is a list item.

    Lines end a sentence, as do full stops; a question runs on into its answer. Lines without a full stop that are no list items are
    headings and are left out.
    """
    out = []
    for line in text.split("\n"):
        parts = [p for p in (p.strip() for p in _SPLIT.split(line)) if p]
        for p in parts:
            item = p.startswith("- ")
            if item or p[-1] in ".。!！?？" or len(parts) > 1:
                out.append((p, item))
    return out


def terms(sentence: str) -> list[str]:
    """Words and pairs of neighbouring words in lower case; pairs and triples of characters of scripts without blanks."""
    s = sentence.lower()
    out: list[str] = []
    runs = _CJK.findall(s)
    for run in runs:
        out += [run[i : i + 2] for i in range(len(run) - 1)]
        out += [run[i : i + 3] for i in range(len(run) - 2)]
    words = _WORD.findall(_CJK.sub(" ", s) if runs else s)
    out += words
    out += [f"{a} {b}" for a, b in zip(words, words[1:])]
    return out


def source_name(source: str | None) -> str:
    return re.sub(r"[\s_]+", "-", (source or "").strip().lower())


def _structure(items: list[bool], words: list[int]) -> list[float]:
    n = max(len(items), 1)
    return [np.log1p(len(items)), sum(items) / n, np.log1p(sum(words) / n)]


@dataclass
class Model:
    """Everything needed to decide a document: arrays and plain dictionaries only."""

    subjects: list[str]
    vocabulary: dict[str, int]
    index: Index
    weights: np.ndarray  # terms x (subjects + 1): log odds against the mean class, the last class is no subject
    prior: np.ndarray
    sources: dict[str, int]
    order: list[int] = field(default_factory=list)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    chain: list[np.ndarray] = field(default_factory=list)
    platt: list[tuple[float, float]] = field(default_factory=list)


class Index:
    """A vocabulary for looking up a whole batch at once: words by a dictionary, pairs of words by their numbers in a sorted array."""

    def __init__(self, vocabulary: dict[str, int]) -> None:
        plain = {t: i for t, i in vocabulary.items() if not _CJK.search(t)}
        self.runs = {t: i for t, i in vocabulary.items() if t not in plain}
        parts = [(t.split(" "), i) for t, i in plain.items()]
        self.words = {w: n for n, w in enumerate(dict.fromkeys(w for ws, _ in parts for w in ws))}
        # The last place stands for unknown words.
        self.word_term = np.full(len(self.words) + 1, -1, np.int64)
        codes = {}
        for ws, i in parts:
            if len(ws) == 1:
                self.word_term[self.words[ws[0]]] = i
            else:
                codes[self.words[ws[0]] * len(self.words) + self.words[ws[1]]] = i
        self.pair_codes = np.array(sorted(codes), np.int64)
        self.pair_term = np.array([codes[c] for c in self.pair_codes.tolist()], np.int64)


def _encode(texts: list[str], index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[list[bool], list[int]]]]:
    """Term ids of all sentences in one array, the start of each sentence in it, the document of each sentence, and each document's structure.

    The terms are those of ``terms``; here they are found for all sentences together.
    """
    words: list[str] = []
    n_words: list[int] = []
    grams: list[str] = []
    n_grams: list[int] = []
    owner, shape = [], []
    for d, text in enumerate(texts):
        items, lengths = [], []
        for sentence, item in sentences(text.lower()):
            runs = () if sentence.isascii() else _CJK.findall(sentence)
            before = len(grams)
            for run in runs:
                grams += map(add, run, run[1:])
                grams += map("".join, zip(run, run[1:], run[2:]))
            found = _WORD.findall(_CJK.sub(" ", sentence) if runs else sentence)
            words += found
            n_words.append(len(found))
            n_grams.append(len(grams) - before)
            owner.append(d)
            items.append(item)
            lengths.append(len(found) + sum(map(len, runs)))
        shape.append((items, lengths))
    n = len(owner)
    at = np.repeat(np.arange(n), n_words) if n else np.zeros(0, np.int64)
    number = np.fromiter(map(index.words.get, words, repeat(-1)), np.int64, len(words))
    single = index.word_term[number]
    gram = np.fromiter(map(index.runs.get, grams, repeat(-1)), np.int64, len(grams))
    gram_at = np.repeat(np.arange(n), n_grams) if n else np.zeros(0, np.int64)
    ids, place = [single[single >= 0], gram[gram >= 0]], [at[single >= 0], gram_at[gram >= 0]]
    if len(index.pair_codes) and len(number) > 1:
        joined = np.flatnonzero((at[1:] == at[:-1]) & (number[1:] >= 0) & (number[:-1] >= 0))
        code = number[joined] * len(index.words) + number[joined + 1]
        found_at = np.minimum(np.searchsorted(index.pair_codes, code), len(index.pair_codes) - 1)
        hit = index.pair_codes[found_at] == code
        ids.append(index.pair_term[found_at[hit]])
        place.append(at[joined[hit]])
    all_ids, all_places = np.concatenate(ids), np.concatenate(place)
    order = np.argsort(all_places, kind="stable")
    counts = np.bincount(all_places, minlength=n)
    return all_ids[order], np.cumsum(counts) - counts, np.array(owner, np.int64), shape


#: Sentences whose term rows are held in memory together.
_BLOCK = 8_192


def _sentence_scores(weights: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the weights of each sentence's terms, block by block."""
    out = np.zeros((len(starts), weights.shape[1]))
    ends = np.append(starts[1:], len(ids))
    for a in range(0, len(starts), _BLOCK):
        b = min(a + _BLOCK, len(starts))
        first = starts[a]
        # One row more, as a last sentence may be empty and start behind the others.
        rows = np.vstack([weights[ids[first : ends[b - 1]]], np.zeros((1, weights.shape[1]))])
        part = np.add.reduceat(rows, starts[a:b] - first, axis=0)
        # For an empty sentence reduceat gives the element at its start.
        part[ends[a:b] == starts[a:b]] = 0
        out[a:b] = part
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _by_document(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, values.shape[1]))
    np.add.at(out, owner, values)
    return out


def document_shares(model: Model, texts: list[str]) -> tuple[np.ndarray, list[list[float]]]:
    """Share of each subject in the sentences of each text, and the texts' structure.

    A first pass finds what the document deals with, a second reads ambiguous sentences in that light.
    """
    ids, starts, owner, shape = _encode(texts, model.index)
    n = len(texts)
    score = _sentence_scores(model.weights, ids, starts)
    counts = np.maximum(np.bincount(owner, minlength=n), 1)[:, None] if len(owner) else np.ones((n, 1))
    prior = np.log(model.prior)
    post = _softmax(score + prior) if len(score) else score
    for _ in range(2):
        if not len(score):
            break
        share = (_by_document(post, owner, n) + model.prior) / (counts + 1)
        post = _softmax(score + np.log(share)[owner])
    share = _by_document(post, owner, n) / counts if len(score) else np.zeros((n, len(model.prior)))
    return share[:, :-1], [_structure(*s) for s in shape]


def fit_terms(texts: list[str], labels: list[set[str]], subjects: list[str], sources: list[str]) -> Model:
    """The naive Bayes model of sentences, by expectation maximisation over reviewed documents."""
    seen: Counter[str] = Counter()
    for text in texts:
        seen.update({t for s, _ in sentences(text) for t in terms(s)})
    kept = sorted((t for t, c in seen.items() if c >= 2), key=lambda t: (-seen[t], t))
    vocabulary = {t: i for i, t in enumerate(kept)}
    index = Index(vocabulary)
    ids, starts, owner, _ = _encode(texts, index)
    k = len(subjects) + 1
    allowed = np.full((len(texts), k), _PASSING / k)
    allowed[:, -1] = 0.4
    place = {s: i for i, s in enumerate(subjects)}
    for d, names in enumerate(labels):
        for s in names:
            if s in place:
                allowed[d, place[s]] = 1.0
    lengths = np.diff(np.append(starts, len(ids)))
    sentence_of = np.repeat(np.arange(len(starts)), lengths)
    allowed = allowed / allowed.sum(1, keepdims=True)
    post = allowed[owner] if len(owner) else np.zeros((0, k))
    # A long document counts as some sentences only, else one with a wrong review makes up a rare subject.
    weight = np.minimum(1, _SENTENCES_COUNTED / np.maximum(np.bincount(owner, minlength=len(texts)), 1))[owner][:, None] if len(owner) else np.zeros((0, 1))
    weights, prior = np.zeros((len(vocabulary), k)), np.full(k, 1 / k)
    # A term speaks for a subject only if it is more frequent among the subject's documents than among the others.
    known = np.array([[s in names for s in subjects] for names in labels], float).reshape(len(texts), len(subjects))
    pairs = np.unique(owner[sentence_of] * max(len(vocabulary), 1) + ids) if len(ids) else np.zeros(0, np.int64)
    doc_of, term_of = np.divmod(pairs, max(len(vocabulary), 1))
    inside = np.stack([np.bincount(term_of, known[doc_of, c], len(vocabulary)) for c in range(len(subjects))], 1) if len(pairs) else np.zeros((len(vocabulary), len(subjects)))
    outside = np.bincount(term_of, minlength=len(vocabulary))[:, None] - inside
    lift = ((inside + 0.1) / (known.sum(0) + 1)) / ((outside + 0.1) / ((1 - known).sum(0) + 1))
    mute = np.hstack([lift < _LIFT, np.zeros((len(vocabulary), 1), bool)])
    for _ in range(_ROUNDS):
        counts = np.stack([np.bincount(ids, (post * weight)[sentence_of, c], len(vocabulary)) for c in range(k)], 1) if len(ids) else np.zeros((len(vocabulary), k))
        mean = (counts.sum(1, keepdims=True) + 1e-3) / (counts.sum() + 1e-3 * max(len(vocabulary), 1))
        weights = np.log((counts + _SMOOTH * mean) / (counts.sum(0) + _SMOOTH) / mean)
        weights[mute] = np.minimum(weights[mute], 0)
        prior = ((post * weight).sum(0) + 1) / ((post * weight).sum() + k)
        if not len(starts):
            break
        post = _softmax(_sentence_scores(weights, ids, starts) + np.log(allowed)[owner])
    names = sorted(set(sources))
    return Model(subjects, vocabulary, index, weights.astype(np.float32), prior, {s: i for i, s in enumerate(names)})


def _features(model: Model, shares: np.ndarray, structure: list[list[float]], sources: list[str]) -> np.ndarray:
    """Shares, their squares, which subject leads, structure and source, one row per document."""
    n = len(shares)
    one_hot = np.zeros((n, len(model.sources)))
    for i, s in enumerate(sources):
        if (j := model.sources.get(s)) is not None:
            one_hot[i, j] = 0.3
    best = np.sort(shares, 1)[:, ::-1]
    top = best[:, :2] if shares.shape[1] > 1 else np.repeat(best, 2, 1)
    return np.hstack([shares, np.minimum(shares, 0.4) * 2, np.array(structure, float).reshape(n, 3), top, one_hot])


def _fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.3, rounds: int = 30) -> np.ndarray:
    """Regularised logistic regression by Newton's method; the last coefficient is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), l2)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + penalty * w
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _focus(model: Model, base: np.ndarray, j: int, before: np.ndarray) -> np.ndarray:
    """Input of the chain's classifier of subject j: all features, j's own share again, and the decisions so far."""
    k = len(model.subjects)
    # A document of unusual length or source must not outweigh its shares.
    usual = np.clip((base - model.mean) / model.scale, -2, 2)
    return np.hstack([base[:, k + j : k + j + 1] * 6, base[:, j : j + 1] * 3, usual * 0.3, before * 0.5])


def fit_chain(model: Model, texts: list[str], labels: list[set[str]], sources: list[str]) -> Model:
    """Adds the calibrated chain to a model of terms: four fifths of the documents fit it, one fifth calibrates it.

    Reviews name documents of some subject only. So that the chain does not learn that the last subject follows from the absence of all
    others, documents of no subject are added: a tenth of the reviewed ones with all but their mentions in passing taken out.
    """
    shares, structure = document_shares(model, texts)
    y = np.array([[s in names for s in model.subjects] for names in labels], float).reshape(len(texts), len(model.subjects))
    bare = np.sort(np.random.default_rng(SEED + 1).permutation(len(texts))[: -(-len(texts) // 10)])
    shares = np.vstack([shares, np.where(shares[bare] < 0.1, shares[bare], 0)])
    structure, sources = structure + [structure[i] for i in bare], sources + [sources[i] for i in bare]
    y = np.vstack([y, np.zeros((len(bare), y.shape[1]))])
    x = _features(model, shares, structure, sources)
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-6
    model.order = [int(i) for i in np.argsort(-y.sum(0), kind="stable")]
    held = np.random.default_rng(SEED).random(len(x)) < 0.2
    if held.sum() < 20 or (~held).sum() < 20:
        held[:] = False
    for place, j in enumerate(model.order):
        before = y[:, model.order[:place]]
        z = _focus(model, x, j, before)
        w = _fit_logistic(z[~held], y[~held, j])
        a, b = 1.0, 0.0
        if held.any() and 0 < y[held, j].sum() < held.sum():
            score = np.hstack([z[held], np.ones((held.sum(), 1))]) @ w
            a, b = _fit_logistic(score[:, None] / 4, y[held, j], 0.05)
            a = max(a / 4, 0.05)
        model.chain.append(w)
        model.platt.append((float(a), float(b)))
    return model


def decode(model: Model, shares: np.ndarray, structure: list[list[float]], sources: list[str], width: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """The most probable combination of subjects per document by beam search, and its probability."""
    n, k = shares.shape
    x = _features(model, shares, structure, sources)
    beams = [(np.zeros((n, 0)), np.zeros(n))]
    for place, j in enumerate(model.order):
        grown = []
        for before, log_p in beams:
            z = np.hstack([_focus(model, x, j, before), np.ones((n, 1))])
            a, b = model.platt[place]
            t = np.clip(a * (z @ model.chain[place]) + b, -30, 30)
            for choice in (0.0, 1.0):
                grown.append((np.hstack([before, np.full((n, 1), choice)]), log_p - np.log1p(np.exp(-t if choice else t))))
        scores = np.stack([g[1] for g in grown], 1)
        best = np.argsort(-scores, 1, kind="stable")[:, :width]
        paths = np.stack([g[0] for g in grown], 1)
        rows = np.arange(n)
        beams = [(paths[rows, best[:, i]], scores[rows, best[:, i]]) for i in range(best.shape[1])]
    path, log_p = beams[0]
    out = np.zeros((n, k), bool)
    out[:, model.order] = path > 0.5
    return out, np.exp(log_p)


def train(labelled: pd.DataFrame, subjects: list[str]) -> Model:
    """A model from ``text, source, subjects`` (a list per document)."""
    texts = [t or "" for t in labelled["text"]]
    labels = [set(s) for s in labelled["subjects"]]
    sources = [source_name(s) for s in labelled["source"]]
    return fit_chain(fit_terms(texts, labels, subjects, sources), texts, labels, sources)


def predict(model: Model, texts: list[str], sources: list[str]) -> list[list[str]]:
    """Subjects of each text; none where no sentence was found."""
    if not texts:
        return []
    shares, structure = document_shares(model, texts)
    chosen, _ = decode(model, shares, structure, sources)
    chosen &= shares.sum(1, keepdims=True) > 0
    return [[model.subjects[j] for j in np.flatnonzero(row)] for row in chosen]


def labelled_sample(documents: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> pd.DataFrame:
    """``text, source, subjects`` of at most ``limit`` documents with reviewed subjects, by a seeded hash of the document.

    Repeated reviews count once; reviews of unknown documents or with nulls count not at all.
    """
    reviewed = labels.where("doc_id IS NOT NULL AND subject IS NOT NULL").groupBy("doc_id").agg(F.sort_array(F.collect_set("subject")).alias("subjects"))
    chosen = reviewed.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(limit)
    chosen = chosen.toPandas()
    # The limit bounds the keys; as literals they reach the reader, which skips what lies outside them, and the texts are not shuffled.
    ids = [int(i) for i in chosen["doc_id"]]
    keys = documents.sparkSession.createDataFrame([(int(i), list(s)) for i, s in zip(chosen["doc_id"], chosen["subjects"])], "doc_id long, subjects array<string>")
    rows = documents.select("doc_id", "text", "source").where(F.col("doc_id").isin(ids) & F.col("text").isNotNull()).join(F.broadcast(keys), "doc_id")
    return rows.select("doc_id", "text", "source", "subjects").toPandas().sort_values("doc_id", kind="stable")


#: Characters decided at once; bounds a worker's memory whatever the batches.
_CHUNK = 1_000_000


def document_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, subject``: the subject areas of each document.

    ``documents`` has ``doc_id, text, source``; ``labels`` has ``doc_id, subject``; ``subjects`` names the areas. Documents
    with null, empty or wordless text have no area. Without labels there is nothing to learn from and no row comes
    out. Texts of any length are read whole; equal texts of one source get equal areas.
    """
    spark = documents.sparkSession
    names = sorted(r.subject for r in subjects.select("subject").distinct().collect() if r.subject is not None)
    sample = labelled_sample(documents, labels, limit)
    if sample.empty or not names:
        return documents.select("doc_id", F.lit("").alias("subject")).limit(0)
    model = spark.sparkContext.broadcast(train(sample, names))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for batch in batches:
            batch = batch[batch["text"].notna() & (batch["text"] != "")]
            chunk = (batch["text"].str.len().cumsum() // _CHUNK).to_numpy()
            for _, part in batch.groupby(chunk, sort=False):
                found = predict(m, part["text"].tolist(), [source_name(s) if isinstance(s, str) else "" for s in part["source"]])
                yield part[["doc_id"]].assign(subject=found).explode("subject").dropna(subset=["subject"])

    return spread(documents.select("doc_id", "text", "source")).mapInPandas(decide, "doc_id long, subject string")


def composition(found: DataFrame) -> DataFrame:
    """Documents and share of all assignments per subject."""
    counted = found.groupBy("subject").agg(F.count(F.lit(1)).alias("n_docs"))
    total = counted.agg(F.sum("n_docs").alias("total"))
    return counted.crossJoin(F.broadcast(total)).select("subject", "n_docs", F.round(F.col("n_docs") / F.col("total"), 6).alias("share"))
