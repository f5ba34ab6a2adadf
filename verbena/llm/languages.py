"""The language of documents and of their segments, by unigrams over a fixed vocabulary.

For each language, pieces of a public vocabulary have probabilities; the score of a text is
the sum over all its segmentations into pieces, computed by the forward algorithm. Pieces
never cross the border of a word, so the sum of a text is the product of the sums of its
words, and a worker computes each distinct word once; words of any length are summed whole, in
logarithms where they are long. The probabilities are fitted by
expectation maximisation on a bounded sample of labelled documents (the `per_language` smallest
hashes of ids of each language, of texts up to `longest` characters), first as labelled, then with every segment under the language
that scores it best, so wrong labels and mixed documents don't stay in the models.

A document is cut at line breaks, written-out line breaks, sentence ends and the signs that
part bilingual pairs. A segment is a sentence if it has `min_words` words and an end mark, or
half as many again without one. Its confidence is the posterior of its language under equal
priors. A document is mixed if sentences of several languages stand in it, each with enough
confidence and margin; else its language is that of all its sentences together.

Null, empty and blank texts and texts without a sentence get a null language and confidence
0. Labels are matched exactly against the table of labels; null or unknown ones are missing.
Repeated documents are judged alike. Texts are processed whole. Extra columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship

WORD = re.compile(r"[^\W\d_]+")
MARKUP = re.compile(r"\[[^\[\]\s]{1,60}\]|<[^<>\n]{1,60}>|\{[^{}\s]{1,40}\}")
BORDER = re.compile(r"""\r\n|\n|\r|\t|\\r|\\n|\\t|\s=>\s|\s/\s|\s\|\s|\s=\s"|(?<=[.!?…])["'”’»)\]]*\s+""")
END = re.compile(r"""[.!?…]["'”’»)\]\s]*$""")
#: Longer words are summed in logarithms, so that no sum underflows.
PLAIN = 32
KEEP = 300_000


def segments(text: str) -> Iterator[tuple[int, int]]:
    """Begin and end of each non-blank segment of a text."""
    at = 0
    for m in BORDER.finditer(text):
        if text[at : m.start()].strip():
            yield at, m.start()
        at = m.end()
    if text[at:].strip():
        yield at, len(text)


def words_of(segment: str) -> list[str]:
    return WORD.findall(MARKUP.sub(" ", segment).lower())


def is_sentence(segment: str, n_words: int, min_words: int) -> bool:
    return n_words >= min_words and (bool(END.search(segment)) or 2 * n_words >= 3 * min_words)


def read_pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece vocabulary, in lower case, without controls and bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p.lower() for p in kept if re.fullmatch(r"▁?[^\W\d_]*", p) and p})


@dataclass
class PieceModels:
    """Piece probabilities by language, and the sums of words under them."""

    languages: list[str]
    index: dict[str, int]
    p: np.ndarray
    unknown: float = 1e-7
    _cache: dict[str, int] = field(default_factory=dict, repr=False)
    _rows: np.ndarray | None = field(default=None, repr=False)

    def __post_init__(self):
        self.longest = max(map(len, self.index), default=1)

    def __getstate__(self):
        return self.__dict__ | {"_cache": {}, "_rows": None}

    def lattice(self, word: str) -> Iterator[tuple[int, int, int]]:
        """Begin, end and piece of every piece that fits into a word; single characters always do."""
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + self.longest) + 1):
                k = self.index.get(word[i:j], -1)
                if k >= 0 or j == i + 1:
                    yield i, j, k

    def forward(self, word: str) -> np.ndarray:
        """The log of the sum over all segmentations up to each place, for each language."""
        if len(word) <= PLAIN:
            alpha = np.zeros((len(word) + 1, len(self.languages)))
            alpha[0] = 1
            for i, j, k in self.lattice(word):
                alpha[j] += alpha[i] * (self.p[k] if k >= 0 else self.unknown)
            return np.log(alpha)
        logp, unknown = np.log(self.p), np.log(self.unknown)
        alpha = np.full((len(word) + 1, len(self.languages)), -np.inf)
        alpha[0] = 0
        for i, j, k in self.lattice(word):
            np.logaddexp(alpha[j], alpha[i] + (logp[k] if k >= 0 else unknown), out=alpha[j])
        return alpha

    def word(self, word: str) -> np.ndarray:
        return self.forward("▁" + word)[-1]

    def places(self, words: list[str]) -> list[int]:
        """The row of each word's sums in `_rows`; words not met before are summed now."""
        cache, at = self._cache, []
        for w in words:
            i = cache.get(w)
            if i is None:
                i = cache[w] = len(cache)
                if self._rows is None or i >= len(self._rows):
                    grown = np.empty((max(1024, 2 * i), len(self.languages)))
                    if i:
                        grown[:i] = self._rows[:i]
                    self._rows = grown
                self._rows[i] = self.word(w)
            at.append(i)
        return at

    def forget(self) -> None:
        """Start the cache anew if it has grown large; places given before are void."""
        if len(self._cache) >= KEEP:
            self._cache.clear()

    def sums(self, places: list[int], starts: list[int]) -> np.ndarray:
        """The sums of runs of words that start at these places, a row each."""
        return np.add.reduceat(self._rows[places], starts, axis=0)

    def scores(self, words: list[str]) -> np.ndarray:
        """The log of the sum over all segmentations of some words, for each language."""
        self.forget()
        return self.sums(self.places(words), [0])[0] if words else np.zeros(len(self.languages))


def fit(counts: dict[str, Counter], languages: list[str], pieces: list[str], rounds: int = 3, background: float = 0.1) -> PieceModels:
    """Expectation maximisation for each language, mixed with the mean of all languages."""
    longest, known = max(map(len, pieces), default=0), set(pieces)
    seen = {g for c in counts.values() for w in c for m in ["▁" + w] for i in range(len(m)) for j in range(i + 1, min(len(m), i + longest) + 1) if (g := m[i:j]) in known}
    used = sorted(seen)
    index = {p: i for i, p in enumerate(used)}
    models = PieceModels(languages, index, np.full((len(used), len(languages)), 1 / max(1, len(used))))
    for _ in range(rounds):
        expected = np.full_like(models.p, 1e-6)
        for column, language in enumerate(languages):
            for word, n in counts.get(language, {}).items():
                _expect(models, column, "▁" + word, n, expected)
        if not expected.size:
            break
        p = expected / expected.sum(axis=0)
        models = PieceModels(languages, index, (1 - background) * p + background * p.mean(axis=1, keepdims=True))
    return models


def _expect(models: PieceModels, column: int, word: str, n: int, expected: np.ndarray) -> None:
    """Add how often each piece is expected in n times a word."""
    lattice, size = list(models.lattice(word)), len(word) + 1
    if len(word) > PLAIN:
        logs = [np.log(models.p[k, column] if k >= 0 else models.unknown) for _, _, k in lattice]
        ahead, behind = np.full(size, -np.inf), np.full(size, -np.inf)
        ahead[0] = behind[-1] = 0
        for (i, j, _), w in zip(lattice, logs, strict=True):
            ahead[j] = np.logaddexp(ahead[j], ahead[i] + w)
        for (i, j, _), w in zip(reversed(lattice), reversed(logs), strict=True):
            behind[i] = np.logaddexp(behind[i], behind[j] + w)
        for (i, j, k), w in zip(lattice, logs, strict=True):
            if k >= 0:
                expected[k, column] += n * np.exp(ahead[i] + w + behind[j] - ahead[-1])
        return
    forward, backward = [0.0] * size, [0.0] * size
    forward[0] = backward[-1] = 1.0
    weight = [models.p[k, column] if k >= 0 else models.unknown for _, _, k in lattice]
    for (i, j, _), w in zip(lattice, weight, strict=True):
        forward[j] += forward[i] * w
    for (i, j, _), w in zip(reversed(lattice), reversed(weight), strict=True):
        backward[i] += w * backward[j]
    if forward[-1] > 0:
        for (i, j, k), w in zip(lattice, weight, strict=True):
            if k >= 0:
                expected[k, column] += n * forward[i] * w * backward[j] / forward[-1]


def labelled_sample(documents: DataFrame, labels: DataFrame, per_language: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", longest: int = 50_000) -> list[tuple[str, str]]:
    """Language as labelled and text of the `per_language` documents a language whose ids have the smallest hashes.

    Texts of more than `longest` characters aren't fitted on. A threshold on the hash leaves
    about four times as many documents of each language as are wanted; these are ranked.
    """
    known = labels.select(F.col("label").alias("_label"), F.col("lang").alias("_lang")).distinct()
    rows = documents.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(text_col).alias("_text")).filter(F.col("_label").isNotNull() & (F.char_length("_text") <= longest))
    sizes = {r["_lang"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).join(known, "_label").groupBy("_lang").agg(F.sum("n").alias("n")).collect()}
    if not sizes:
        return []
    # hashes are spread evenly over all longs
    below = {lang: int(-(2**63) + 2**64 * min(1.0, 4 * per_language / n)) for lang, n in sizes.items()}
    limit = F.create_map(*[F.lit(x) for lang, t in sorted(below.items()) for x in (lang, min(t, 2**63 - 1))])
    place = F.xxhash64("_id").alias("_place")
    chosen = rows.join(F.broadcast(known), "_label").select("_lang", "_text", place).filter(F.col("_place") <= limit[F.col("_lang")])  # the labels are a fixed table
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_place", "_text"))
    return [(r["_lang"], r["_text"]) for r in chosen.withColumn("_rank", rank).filter(F.col("_rank") <= per_language).select("_lang", "_text").collect()]


def learn(documents: DataFrame, labels: DataFrame, vocabulary: str, per_language: int = 120, relabel: int = 2, min_words: int = 4) -> PieceModels:
    """Models of every language that the table of labels names."""
    languages = sorted({r.lang for r in labels.select("lang").distinct().collect()})
    sample = sorted(labelled_sample(documents, labels, per_language))
    pieces = read_pieces(vocabulary)
    cut = [(lang, w) for lang, text in sample for a, b in segments(text) for w in [words_of(text[a:b])] if is_sentence(text[a:b], len(w), min_words)]
    models = None
    for _ in range(1 + relabel):
        counts: dict[str, Counter] = defaultdict(Counter)
        for lang, words in cut:
            counts[lang if models is None else languages[int(models.scores(words).argmax())]].update(words)
        models = fit(counts, languages, pieces)
    return models


LANGS = pa.list_(pa.struct([("lang", pa.string()), ("sentences", pa.int32()), ("confidence", pa.float64())]))


def judge(models: PieceModels, texts: list[str | None], min_words: int) -> tuple[list[tuple[int, int, int, bool]], np.ndarray]:
    """All segments of some texts (text, begin, end, sentence) and their scores; segments without a word score 0."""
    found: list[tuple[int, int, int, bool]] = []
    rows, starts, places = [], [], []
    models.forget()
    for n, text in enumerate(texts):
        for begin, end in segments(text or ""):
            segment = text[begin:end]
            words = words_of(segment)
            if words and models.languages:
                rows.append(len(found))
                starts.append(len(places))
                places += models.places(words)
            found.append((n, begin, end, is_sentence(segment, len(words), min_words)))
    scores = np.zeros((len(found), len(models.languages)))
    if rows:
        scores[rows] = models.sums(places, starts)
    return found, scores


def posteriors(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its posterior and its lead over the next, for each row of scores."""
    if not scores.size:
        none = np.zeros(len(scores))
        return none.astype(int), none, none
    top = scores.max(axis=1)
    second = np.partition(scores, -2, axis=1)[:, -2] if scores.shape[1] > 1 else np.full(len(scores), -np.inf)
    return scores.argmax(axis=1), 1 / np.exp(scores - top[:, None]).sum(axis=1), top - second


def with_languages(documents: DataFrame, models: PieceModels, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", min_words: int = 4, margin: float = 5.0) -> DataFrame:
    """id, label, detected language, confidence and the languages of the sentences of each document.

    `margin` is the log of how much better a sentence's language must be than any other for
    the sentence to make a document mixed.
    """
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(models)  # bounded by the vocabulary
    schema = f"`{id_col}` {documents.schema[id_col].dataType.simpleString()}, label string, detected string, confidence double, langs array<struct<lang:string,sentences:int,confidence:double>>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found, scores = judge(m, texts, min_words)
            best, post, lead = posteriors(scores)
            total, judged = np.zeros((len(texts), len(m.languages))), np.zeros(len(texts), dtype=bool)
            by: list[dict[int, list[float]]] = [defaultdict(list) for _ in texts]
            for k, (n, _, _, sentence) in enumerate(found):
                if sentence and m.languages:
                    total[n] += scores[k]
                    judged[n] = True
                    if lead[k] >= margin:
                        by[n][int(best[k])].append(float(post[k]))
            whole, sure, _ = posteriors(total)
            lang = [m.languages[whole[n]] if judged[n] else None for n in range(len(texts))]
            confidence = [float(sure[n]) if judged[n] else 0.0 for n in range(len(texts))]
            langs = [[(m.languages[k], len(v), sum(v) / len(v)) for k, v in sorted(x.items())] for x in by]
            columns = [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(confidence, pa.float64()), pa.array([[dict(zip(("lang", "sentences", "confidence"), x, strict=True)) for x in y] for y in langs], LANGS)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "label", "detected", "confidence", "langs"])

    return documents.select(F.col(id_col), F.col(label_col).cast("string").alias("label"), F.col(text_col)).mapInArrow(run, schema)


def with_segments(documents: DataFrame, models: PieceModels, id_col: str = "doc_id", text_col: str = "text", min_words: int = 4) -> DataFrame:
    """id, segment, begin, length, sentence, lang, confidence of each segment of each document."""
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(models)
    names = [id_col, "segment", "begin", "length", "sentence", "lang", "confidence"]
    schema = f"`{id_col}` {documents.schema[id_col].dataType.simpleString()}, segment int, begin int, length int, sentence boolean, lang string, confidence double"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found, scores = judge(m, batch.column(1).to_pylist(), min_words)
            best, post, _ = posteriors(scores)
            rows, before, n = [], -1, 0
            for k, (text, begin, end, sentence) in enumerate(found):
                n = n + 1 if text == before else 0
                before = text
                told = scores.shape[1] > 0 and scores[k].any()
                rows.append((text, n, begin, end, sentence, m.languages[best[k]] if told else None, float(post[k]) if told else 0.0))
            ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int32()))
            rest = [[r[1] for r in rows], [r[2] for r in rows], [r[3] - r[2] for r in rows], [r[4] for r in rows], [r[5] for r in rows], [r[6] for r in rows]]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(v, k) for v, k in zip(rest, kinds, strict=True))], names=names)

    return documents.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def label_faults(judged: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, kind, lang, confidence of mixed documents (one row a language) and of missing or wrong labels."""
    known = labels.groupBy("label").agg(F.min("lang").alias("_named"))
    rows = judged.filter("detected is not null").join(F.broadcast(known), "label", "left")  # the labels are a fixed table
    kind = F.when(F.col("_named").isNull(), "missing").when(F.col("_named") != F.col("detected"), "wrong")
    fault = lambda kind, lang, confidence: F.struct(kind.alias("kind"), lang.alias("lang"), confidence.alias("confidence"))
    mixed = F.transform("langs", lambda x: fault(F.lit("mixed"), x["lang"], x["confidence"]))
    faults = F.when(F.size("langs") > 1, mixed).otherwise(F.array(fault(kind, F.col("detected"), F.col("confidence"))))
    return rows.select(id_col, F.explode(faults).alias("x")).filter("x.kind is not null").select(id_col, "x.kind", "x.lang", "x.confidence")
