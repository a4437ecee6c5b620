"""Language identification of words by a linear-chain conditional random field.

Words are runs of letters and their combining marks. A word's features are its affixes, the n-grams of its letters (with edges), its shape and
whether it is in a language's lexicon, as learned from the sample; they are hashed to a table of weights. Between
neighbouring words there are learned transitions. Forward-backward gives each word its distribution over languages,
so code-switched texts are labelled by stretches; a document's language is the one with the most words expected.

The model is fitted, by gradient steps on the exact likelihood until that settles, on different labelled texts drawn by a hash of the text from
all of them, evenly from all languages: `max_docs`, or LEAST a language if these are more. Of a text of over WORDS_EACH words, pieces from all of
it make up so many; so the driver holds max(max_docs, LEAST languages) * WORDS_EACH words at most, and half a megabyte of weights a language. Sequences
for learning are pieces of these, half of them made of pieces of several, so that transitions between languages occur. What is predicted from is the text alone.

Cases: a text that is null or has no letter is `und` with score 0 (numerals such as ½ or Ⅷ are no letters); without any
labelled document all texts are `und`; texts and words of any length are labelled whole; repeated rows stay; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import materialize

WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: The same for texts below U+0250, where all from U+00F8 on are letters and none are marks.
LATIN = re.compile(r"[\x00-\u024f]*\Z")
LATIN_WORDS = re.compile(r"[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+")
#: Words of a sequence for learning; most words of a text, and fewest texts of a language, to learn from.
PIECE, WORDS_EACH, LEAST = 80, 6000, 4
#: Steps to take at least, times to go through all sequences at most, and what a time must gain of the cost (nats a word) to go on.
STEPS, EPOCHS, GAIN = 60, 60, 0.05
BUCKETS = 1 << 16
#: Characters whose words are held at once, and words whose weights are remembered.
BATCH_CHARS = 4_000_000
REMEMBERED = 200_000
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    text = text or ""
    return (LATIN_WORDS if LATIN.match(text) else WORDS).findall(text)


class _Places(dict):
    """The place of a feature among the weights."""

    def __missing__(self, name: str) -> int:
        if len(self) > 2 * REMEMBERED:
            self.clear()
        found = self[name] = xxhash.xxh32_intdigest(name) % BUCKETS
        return found


_PLACES = _Places()
_CASES = ("case:low", "case:cap", "case:up")


def word_features(word: str) -> list[str]:
    """Names of a word's features."""
    low = word.lower()
    edged = f"<{low}>"
    found = ["w:" + low, _CASES[0 if word[0] == low[0] else 2 if len(word) > 1 and word.isupper() else 1]]
    found += ["p:" + low[:n] for n in range(1, min(4, len(low)) + 1)]
    found += ["s:" + low[-n:] for n in range(1, min(4, len(low)) + 1)]
    found += [edged[i : i + 2] for i in range(len(edged) - 1)]
    found += [edged[i : i + 3] for i in range(len(edged) - 2)]
    return found


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # BUCKETS x labels
    moves: np.ndarray  # labels x labels, from and to
    start: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)  # word: bits of the languages

    def places(self, word: str) -> list[int]:
        found = list(map(_PLACES.__getitem__, word_features(word)))
        bits = self.lexicon.get(word.lower(), 0)
        if bits:
            found += [_PLACES[f"lex:{k}"] for k in range(len(self.labels)) if bits >> k & 1]
        return found

    def emissions(self, words: list[str]) -> np.ndarray:
        places = [self.places(w) for w in words]
        sizes = np.array(list(map(len, places)))
        flat = np.fromiter((p for own in places for p in own), np.int32, sizes.sum())
        return np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes, axis=0) / np.sqrt(sizes)[:, None]


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Posteriors of all words, the expected number of each transition, and the log of all partition sums.

    scores: words x labels of all sequences one after the other. Sequences go through time side by side.
    """
    n_labels = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sequences longer than t
    top = scores.max(axis=1, keepdims=True)
    emit = np.exp(scores - top)
    trans = np.exp(moves)
    alpha, scale = np.empty_like(emit), np.ones(len(emit))
    log_z = float(top.sum())
    now = np.exp(start)[None, :].repeat(len(lengths), 0)
    for t in range(longest):
        k = active[t]
        at = begins[:k] + t
        now = (now[:k] if t == 0 else now[:k] @ trans) * emit[at]
        total = now.sum(axis=1, keepdims=True)
        now = now / total
        alpha[at] = now
        scale[at] = total[:, 0]
    log_z += float(np.log(scale).sum())
    post = np.empty_like(emit)
    pairs = np.zeros((n_labels, n_labels))
    beta = np.ones((0, n_labels))
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = begins[:k] + t
        if k > len(beta):
            beta = np.concatenate([beta, np.ones((k - len(beta), n_labels))])
        post[at] = alpha[at] * beta
        if t:
            back = emit[at] * beta / scale[at][:, None]
            pairs += (alpha[at - 1].T @ back) * trans
            beta = back @ trans.T
    return post, pairs, log_z


def fit(rows: list[tuple[str, str]], seed: int = 5, rate: float = 0.4, decay: float = 1e-4) -> Model:
    """rows: (text, language)."""
    random = np.random.Generator(np.random.PCG64(seed))
    labels = sorted({lang for _, lang in rows})
    docs = []
    for text, lang in rows:
        if words := words_of(text):
            docs.append((words, labels.index(lang)))
    counts = [Counter(w.lower() for words, k in docs if k == i for w in words) for i in range(len(labels))]
    lexicon: dict[str, int] = {}
    for i, c in enumerate(counts):
        for w, n in c.items():
            # among the words of two and more documents' worth, those that the language has mostly to itself
            if n >= 3 and n / max(1, c.total()) >= 0.8 * sum(x[w] / max(1, x.total()) for x in counts):
                lexicon[w] = lexicon.get(w, 0) | 1 << i
    model = Model(labels, np.zeros((BUCKETS, len(labels))), np.zeros((len(labels),) * 2), np.zeros(len(labels)), lexicon)
    # some sequences are of one document, some are switched: pieces of 3 to 12 words of several
    sequences = [[(w, k) for w in words[i : i + PIECE]] for words, k in docs for i in range(0, len(words), PIECE)]
    pool = [(words[i : i + n], k) for words, k in docs for n in [int(random.integers(3, 13))] for i in range(0, len(words), n)]
    random.shuffle(pool)
    sequences += [[(w, k) for words, k in pool[i : i + 8] for w in words] for i in range(0, len(pool) // 2, 8)]
    known: dict[str, np.ndarray] = {}
    places = lambda w: known.setdefault(w, np.array(model.places(w)))
    squares = np.full((BUCKETS, len(labels)), 1e-6)
    move_squares = np.full(model.moves.shape, 1e-6)
    steps, last = 0, np.inf
    for _ in range(EPOCHS):
        random.shuffle(sequences)
        cost, n_words = 0.0, 0
        for at in range(0, len(sequences), 64):
            batch = [s for s in sequences[at : at + 64] if s]
            if not batch:
                continue
            flat = [places(w) for s in batch for w, _ in s]
            gold = np.array([k for s in batch for _, k in s])
            lengths = np.array(list(map(len, batch)))
            sizes = np.array(list(map(len, flat)))
            where, of = np.concatenate(flat), np.repeat(np.arange(len(flat)), sizes)
            norm = 1 / np.sqrt(sizes)
            begins = np.cumsum(sizes) - sizes
            scores = np.add.reduceat(model.weights[where], begins, axis=0) * norm[:, None]
            post, pairs, log_z = forward_backward(scores, lengths, model.moves, model.start)
            inner = np.ones(len(gold), bool)
            inner[np.cumsum(lengths) - lengths] = False
            was, now = gold[np.flatnonzero(inner) - 1], gold[inner]
            cost += log_z - scores[np.arange(len(gold)), gold].sum() - model.moves[was, now].sum()
            n_words += len(gold)
            steps += 1
            error = post
            error[np.arange(len(gold)), gold] -= 1
            error *= norm[:, None]
            used, inverse = np.unique(where, return_inverse=True)
            grad = np.stack([np.bincount(inverse, error[of, k], len(used)) for k in range(len(labels))], axis=1) / len(flat) + decay * model.weights[used]
            squares[used] += grad**2
            model.weights[used] -= rate * grad / np.sqrt(squares[used])
            real = np.zeros_like(pairs)
            np.add.at(real, (was, now), 1)
            move = (pairs - real) / len(flat)
            move_squares += move**2
            model.moves -= rate * 0.2 * move / np.sqrt(move_squares)
        if not n_words or (steps >= STEPS and cost / n_words > (1 - GAIN) * last - 0.002):
            break
        last = cost / n_words
    return model


class Memory(dict):
    """Places of words in a table of their scores. Words met first get a place at once, their scores with the batch."""

    def __init__(self, model: Model):
        self.model, self.fresh, self.scores = model, [], np.zeros((0, len(model.labels)))

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self)
        self.fresh.append(word)
        return found

    def look_up(self, words: list[list[str]]) -> np.ndarray:
        """The scores of all words, one text after the other."""
        if len(self) > REMEMBERED:
            self.clear()
            self.scores = self.scores[:0]
        places = np.concatenate([np.fromiter(map(self.__getitem__, w), np.int32, len(w)) for w in words])
        if self.fresh:
            self.scores = np.concatenate([self.scores, *(self.model.emissions(self.fresh[i : i + 5000]) for i in range(0, len(self.fresh), 5000))])
            self.fresh.clear()
        return self.scores[places]


def label_words(model: Model, texts: list[str | None], memory: Memory) -> tuple[list[np.ndarray], list[list[str]]]:
    """Each word's distribution over model.labels, by text, and the words."""
    words = [words_of(t) for t in texts]
    lengths = np.array(list(map(len, words)), np.int64)
    if not lengths.sum():
        return [np.zeros((0, len(model.labels)))] * len(texts), words
    scores = memory.look_up(words)
    some = lengths > 0
    post, _, _ = forward_backward(scores, lengths[some], model.moves, model.start)
    return np.split(post, np.cumsum(lengths)[:-1]), words


def drawn(text: str) -> str:
    """A text as it is if it has WORDS_EACH words at most, else so many of its words, in pieces from all of it."""
    words = words_of(text)
    if len(words) <= WORDS_EACH:
        return text
    starts = np.linspace(0, len(words) - PIECE, WORDS_EACH // PIECE).astype(int).tolist()
    return " ".join(w for i in starts for w in words[i : i + PIECE])


def sample(df: DataFrame, where: Column, max_docs: int) -> list[tuple[str, str]]:
    """(text, lang) of max_docs different texts with a language, or LEAST a language if these are more; evenly by language, the same at each run."""
    able = df.where(where & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("text").alias("u"))
    sizes = materialize(able.groupBy("lang").agg(F.approx_count_distinct("u").alias("n")), "languages")
    n = sizes.count()
    if not n:
        return []
    each = max(max_docs // n, LEAST)
    # equal texts have equal hashes and count once, so that what passes is some 1.5 times the sample, however often a text or an id is repeated
    share = F.least(F.lit(1.0), F.lit(1.5 * each + 20) / F.greatest("n", F.lit(1)))
    limits = F.broadcast(sizes.select("lang", (share * (1 << 30)).cast("long").alias("most")))  # a row a language
    some = able.join(limits, "lang").where(F.pmod(F.xxhash64(F.lit(11), "u"), F.lit(1 << 30)) <= F.col("most")).groupBy("lang", "u").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(11), "u"), "u"))
    few = some.withColumn("rank", rank).where(F.col("rank") <= each).select("lang", "rank", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(drawn, batch.column(2).to_pylist()), pa.string())], names=["lang", "rank", "text"])

    rows = few.mapInArrow(cut, few.schema).collect()
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["rank"]))]


def identify(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs' id, lang_pred, score (the share of words expected to be in it), n_words and n_switches (of the likeliest label)."""
    schema = f"{id} {dict(docs.dtypes)[id]}, lang_pred string, score double, n_words long, n_switches long"
    own = docs.select(id, text)
    if model is None:
        return own.select(id, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_switches"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights a language, and a lexicon of the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        memory = Memory(model)
        for whole in batches:
            at, texts, ids = 0, [], whole.column(0)
            size = 0
            values = whole.column(1)
            for i in range(whole.num_rows + 1):
                if i == whole.num_rows or size >= BATCH_CHARS:
                    if texts:
                        yield pa.RecordBatch.from_arrays([ids.slice(at, len(texts)), *_predict(model, texts, memory)], names=[id, "lang_pred", "score", "n_words", "n_switches"])
                    at, texts, size = i, [], 0
                if i < whole.num_rows:
                    texts.append(values[i].as_py())
                    size += len(texts[-1] or "")

    return own.mapInArrow(run, schema)


def _predict(model: Model, texts: list[str | None], memory: Memory) -> list[pa.Array]:
    posts, _ = label_words(model, texts, memory)
    langs, scores, ns, switches = [], [], [], []
    for post in posts:
        n = len(post)
        mean = post.sum(axis=0) / max(1, n)
        best = int(mean.argmax())
        langs.append(model.labels[best] if n else UNKNOWN)
        scores.append(float(min(1.0, mean[best])) if n else 0.0)
        ns.append(n)
        switches.append(int((np.diff(post.argmax(axis=1)) != 0).sum()) if n else 0)
    return [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(ns, pa.int64()), pa.array(switches, pa.int64())]


def held_out(id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def languages(documents: DataFrame, max_docs: int = 400) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score and more; learned from documents that aren't held out."""
    rows = sample(documents, ~held_out(), max_docs)
    model = fit(rows) if rows else None
    found = identify(documents, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_words", "n_switches")
