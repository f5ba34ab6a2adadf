"""Defects of prompt and response pairs: empty, refusal, copy, other language, truncated.

Language: a naive Bayes model over character n-grams of words gives posteriors for prompt and
response; a response is in another language if its own posterior favours one and the log odds
have moved away from the prompt's by a margin, so that names and loan words, which stand in
both, don't count. The model is fitted on a bounded sample of labelled documents
(`per_language` of each), whose segments are then put under their best language once more.

Truncation: how likely a text ends is counted over all prompts, for each n-gram at the
end of a word: how often a text ends there, and how often it goes on. Punctuation is put aside,
for a cut text often gets some. N-grams are counted in 2^18 places by their hash, so the table
is bounded whatever the scripts in use. The counts of the pair's own prompt are added with more
weight. Responses whose end isn't nearly certain are candidates; each is then aligned with its
prompt word by word, by an exact edit distance on bit vectors, and one that ends before the
prompt's last words, or within its last word, is truncated.

Refusal: neither prompt nor source text has most of the response's words, and a naive Bayes
model of the same n-grams, fitted on examples of refusals against the sampled documents and
prompts, holds it for a refusal. Copy: letters and digits of the prompt stand unchanged, a lead-in
ending in a colon and markup aside. The first of `empty`, `refusal`, `copy`, `other_language`,
`truncated` that holds is the pair's defect; other pairs get none.

A null or wordless response is `empty` whatever the prompt. With a null prompt only `empty`,
`refusal` and `other_language` can hold. Repeated pairs are judged alike. Texts are read whole.
Extra columns play no part.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import languages

ESCAPE = re.compile(r"\\[nrt]")
LEAD_IN = re.compile(r"^[\s\"'“”‘’«»*#>-]*([^:\n.!?]{2,40}):\s*(?=\S)")
TOKEN = re.compile(r"\S+")
WORD = re.compile(r"[^\W_]+")
#: Training examples of refusals; stories and documents are the other class.
REFUSALS = (
    "Desculpe, mas não posso ajudar com isso.", "Sinto muito, não consigo atender a este pedido.", "Infelizmente não posso traduzir este texto.", "Não é possível revisar este trecho.",
    "Não posso corrigir esta frase porque viola as diretrizes.", "Como modelo de linguagem, não tenho permissão para reescrever o conteúdo solicitado.", "Recuso-me a editar este conteúdo ofensivo.",
    "Prefiro não responder a esta solicitação.", "Lamento, não estou autorizado a avaliar esse material.", "O pedido foge do que me é permitido fazer; envie outro texto, por favor.", "Não vou traduzir a fala sem mais contexto.",
    "Não tenho como processar este conteúdo neste momento.", "Este pedido não está de acordo com as minhas políticas e diretrizes.", "Preciso recusar a revisão desse texto por ser inadequado.", "Não devo comentar este conteúdo.",
    "I'm sorry, but I can't help with that request.", "I cannot translate this text.", "I am unable to assist with editing this content.", "Unfortunately, I can't review this passage.", "As an AI language model, I am not able to rewrite it.",
    "I won't be able to correct this sentence because it violates the guidelines.", "This request goes against my content policy, so I must decline.", "I refuse to proofread harmful content.", "I'm not allowed to process this line without more context.",
    "I must decline to revise this text at this time.", "Sorry, I can not provide a translation for this request.", "It is not possible for me to complete this task.",
    "Lo siento, pero no puedo ayudar con esa solicitud.", "No puedo traducir este texto.", "Como modelo de lenguaje, no me es posible corregir este contenido.", "Esta petición va en contra de las directrices, así que no la revisaré.", "Prefiero no editar esta frase sin más contexto.",
    "Désolé, mais je ne peux pas répondre à cette demande.", "Je ne peux pas traduire ce texte.", "En tant que modèle de langage, je ne suis pas autorisé à corriger ce contenu.", "Cette demande est contraire aux directives; je refuse de la réviser.",
    "Es tut mir leid, aber ich kann dabei nicht helfen.", "Ich kann diesen Text leider nicht übersetzen.", "Als Sprachmodell darf ich diesen Inhalt nicht bearbeiten.", "Diese Anfrage verstößt gegen die Richtlinien, deshalb lehne ich die Korrektur ab.",
    "Mi dispiace, ma non posso aiutare con questa richiesta.", "Non posso tradurre questo testo.", "Come modello linguistico, non mi è permesso correggere questo contenuto.", "Questa richiesta va contro le linee guida, quindi non la modificherò.",
)
END_MARK = re.compile(r"[.!?…][\"'”’»)\]\s]*$")


def has_word(text: str | None) -> bool:
    return bool(text) and any(c.isalnum() for c in text)


def plain(text: str) -> str:
    """A text without markup and written-out line breaks, accents composed."""
    return unicodedata.normalize("NFC", languages.MARKUP.sub(" ", ESCAPE.sub(" ", text)))


def alnum(text: str) -> str:
    return "".join(c for c in text.casefold() if c.isalnum())


def body_of(response: str, prompt: str) -> str:
    """The response without a lead-in that ends in a colon, unless the prompt starts in the same way."""
    m = LEAD_IN.match(response)
    if m and len(m.group(1).split()) <= 5 and not alnum(prompt).startswith(alnum(m.group(1))):
        return response[m.end() :]
    return response


def fold(token: str) -> str:
    """Letters and digits of a token without accents, in lower case."""
    return "".join(c for c in unicodedata.normalize("NFKD", token).casefold() if c.isalnum() and not unicodedata.combining(c))


def share_in(words: list[str], others: set[str]) -> float:
    long = [w for w in words if len(w) > 3] or words
    return sum(w in others for w in long) / len(long) if long else 0.0


@dataclass
class NaiveBayes:
    """Character n-grams of words, one to `n` characters, with word borders."""

    names: list[str]
    index: dict[str, int]
    logp: np.ndarray
    unseen: np.ndarray
    n: int = 3
    _words: dict[str, np.ndarray] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_words": {}}

    def word(self, word: str) -> np.ndarray:
        if word not in self._words:
            if len(self._words) >= languages.KEEP:
                self._words.clear()
            self._words[word] = sum((self.logp[i] if (i := self.index.get(g)) is not None else self.unseen) for g in grams(word, self.n))
        return self._words[word]

    def scores(self, words: list[str]) -> np.ndarray:
        return sum(map(self.word, words), np.zeros(len(self.names)))


def grams(word: str, n: int) -> list[str]:
    marked = f" {word} "
    return [marked[i : i + k] for k in range(2, n + 1) for i in range(len(marked) - k + 1)] + list(word)


def fit(counts: dict[str, Counter], names: list[str], n: int = 3, smooth: float = 0.5) -> NaiveBayes:
    by: list[Counter] = []
    for name in names:
        c: Counter = Counter()
        for word, k in counts.get(name, {}).items():
            for g in grams(word, n):
                c[g] += k
        by.append(c)
    index = {g: i for i, g in enumerate(sorted(set().union(*by)))}
    table = np.full((len(index), len(names)), smooth)
    for column, c in enumerate(by):
        for g, k in c.items():
            table[index[g], column] += k
    total = table.sum(axis=0) + smooth * max(1, len(index))
    return NaiveBayes(names, index, np.log(table / total), np.log(smooth / total), n)


def learn_languages(documents: DataFrame, labels: DataFrame, target: str, per_language: int = 100, relabel: int = 1) -> tuple[NaiveBayes, list[str]]:
    """The model of the target language and of every language that the table of labels names, and the texts it is fitted on."""
    names = sorted({r.lang for r in labels.select("lang").distinct().collect()} | {target})
    sample = sorted(languages.labelled_sample(documents, labels, per_language))
    cut = [(lang, w) for lang, text in sample for a, b in languages.segments(text) for w in [languages.words_of(text[a:b])] if len(w) >= 4]
    model = None
    for _ in range(1 + relabel):
        counts: dict[str, Counter] = defaultdict(Counter)
        for lang, words in cut:
            counts[lang if model is None else names[int(model.scores(words).argmax())]].update(words)
        model = fit(counts, names)
    return model, [text for _, text in sample]


#: Places of the table of ends.
PLACES = 1 << 18


def suffixes(text: str, n: int) -> list[int]:
    """The last n letters or digits of each word of a text, as places of the table of ends."""
    return [zlib.crc32(w[-n:].encode()) % PLACES for w in WORD.findall(text.lower())]


def end_counts(prompts: DataFrame, text_col: str, n: int = 4) -> DataFrame:
    """place, ends, seen: how often the last n letters of a word stand at all and at a text's end, summed in each partition first."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, seen = np.zeros(PLACES, np.int64), np.zeros(PLACES, np.int64)
        for batch in batches:
            grams = [suffixes(text, n) for text in batch.column(0).to_pylist() if text]
            np.add.at(seen, np.fromiter(chain.from_iterable(grams), np.int64), 1)
            np.add.at(ends, np.array([g[-1] for g in grams if g], np.int64), 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(ends[at]), pa.array(seen[at])], names=["place", "ends", "seen"])

    ship(prompts.sparkSession)
    counted = prompts.select(F.col(f"`{text_col}`")).mapInArrow(count, "place int, ends long, seen long")
    return counted.groupBy("place").agg(F.sum("ends").alias("ends"), F.sum("seen").alias("seen"))


@dataclass
class PairJudge:
    model: NaiveBayes
    refusals: NaiveBayes
    ends: dict[int, tuple[int, int]]
    target: str = "pt"
    margin: float = 4.0
    refusal_margin: float = 16.0
    certain: float = 0.98
    own_weight: int = 20
    n: int = 4

    def __post_init__(self):
        self.column = self.model.names.index(self.target)

    def _odds(self, words: list[str]) -> float:
        """The log odds of the best other language against the target language."""
        scores = self.model.scores(words)
        others = np.delete(scores, self.column)
        return float(others.max() - scores[self.column]) if len(others) else 0.0

    def other_language(self, prompt: str, body: str) -> bool:
        words, known = languages.words_of(body), languages.words_of(prompt)
        # most of the words being the prompt's, the few others, names among them, tell nothing
        if share_in(words, set(known)) >= 0.7:
            return False
        odds = self._odds(words)
        return odds > 0 and odds - min(self._odds(known) if known else 0.0, 0.0) >= self.margin

    def refuses(self, prompt: str, body: str, source: str) -> bool:
        words = [fold(w) for w in TOKEN.findall(body)]
        if not all(share_in(words, {fold(w) for w in TOKEN.findall(t)}) < 0.5 for t in (prompt, source) if t):
            return False
        refusal, other = self.refusals.scores(languages.words_of(body))
        return float(refusal - other) >= self.refusal_margin

    def may_end(self, prompt: str, body: str) -> float:
        """The likelihood that a text ends with the body's last n-gram; none where the own prompt goes on after it, for copies of a prompt can't make that an end."""
        tokens, own = suffixes(body, self.n), suffixes(prompt, self.n)
        if not tokens:
            return 0.0
        gram = tokens[-1]
        ends, seen = self.ends.get(gram, (0, 0))
        own_seen = own.count(gram)
        own_ends = int(bool(own) and own[-1] == gram)
        if own_seen > own_ends:
            return 0.0
        return (ends + self.own_weight * own_ends) / (1 + seen + self.own_weight * own_seen)

    def stops_early(self, prompt: str, body: str) -> bool:
        """Whether the body, aligned with the prompt, ends before the prompt's end."""
        a = [w for w in map(fold, TOKEN.findall(prompt)) if w]
        d = [w for w in map(fold, TOKEN.findall(body)) if w]
        if not a or not d:
            return False
        if same(d[-1], a[-1]) and len(d) + 3 >= len(a):
            return False
        reached = aligned_prefix(a, d)
        left = len(a) - reached
        if 0 < left <= 3 and all(d.count(w) >= a.count(w) for w in set(a[reached:])):
            return False  # the words are there, in another order
        if left >= 2:
            return True
        if left == 1:
            return same(a[reached - 1], d[-1]) if reached else True
        cut_word = a[-1] != d[-1] and a[-1].startswith(d[-1])
        return cut_word and (len(a[-1]) - len(d[-1]) >= 2 or bool(END_MARK.search(prompt)) and not END_MARK.search(body))

    def defect(self, prompt: str | None, response: str | None, source: str | None) -> str | None:
        if not has_word(response):
            return "empty"
        before, after = plain(prompt or ""), plain(response)
        body = body_of(after, before)
        if self.refuses(before, after, source or ""):
            return "refusal"
        if before and alnum(before) in (alnum(body), alnum(after)) and has_word(before):
            return "copy"
        if self.other_language(before, body):
            return "other_language"
        if before and self.may_end(before, body) < self.certain and self.stops_early(before, body):
            return "truncated"
        return None


@lru_cache(100_000)
def stripped(word: str) -> str:
    return re.sub("[^a-z0-9]", "", word)


def same(a: str, b: str) -> bool:
    """Words that are equal, or equal but for what an accent or a wrong encoding can change."""
    if a == b:
        return True
    x, y = stripped(a), stripped(b)
    return len(x) > 2 and len(y) > 2 and (x == y or x[:3] == y[:3] and abs(len(x) - len(y)) <= 3 and x[-1] == y[-1])


def aligned_prefix(a: list[str], d: list[str]) -> int:
    """How many words of a the whole of d covers best: the longest prefix at the least edit distance.

    The distance is exact, with words that are the `same` counted as equal. A column of the
    table is two bit vectors of its vertical steps, as whole numbers of len(a) bits, so a word
    of d costs a few operations on such numbers (Myers 1999, global on the side of d).
    """
    exact: dict[str, int] = defaultdict(int)
    alike: dict[tuple[str, str], dict[int, int]] = defaultdict(lambda: defaultdict(int))
    for i, w in enumerate(a):
        exact[w] |= 1 << i
        x = stripped(w)
        if len(x) > 2:
            alike[x[:3], x[-1]][len(x)] |= 1 << i
    places: dict[str, int] = {}
    full = (1 << len(a)) - 1
    up, down = full, 0
    for w in d:
        at = places.get(w)
        if at is None:
            at, y = exact.get(w, 0), stripped(w)
            if len(y) > 2:
                for n, bits in alike.get((y[:3], y[-1]), {}).items():
                    if abs(n - len(y)) <= 3:
                        at |= bits
            places[w] = at
        diagonal = (((at & up) + up) ^ up) | at | down
        right, left = down | ~(diagonal | up), up & diagonal
        # the top row counts the words of d
        right, left = (right << 1) | 1, left << 1
        up, down = (left | ~(diagonal | right)) & full, right & diagonal & full
    size = (len(a) + 7) // 8
    bits = lambda x: np.unpackbits(np.frombuffer(x.to_bytes(size, "little"), np.uint8), bitorder="little")[: len(a)].astype(np.int64)
    distance = np.concatenate(([0], np.cumsum(bits(up) - bits(down))))
    return int(len(a) - np.argmin(distance[::-1]))


def pair_defects(pairs: DataFrame, judge: PairJudge, id_col: str, prompt_col: str, response_col: str, source_col: str | None = None) -> DataFrame:
    """id, defect of each defective pair."""
    ship(pairs.sparkSession)
    shared = pairs.sparkSession.sparkContext.broadcast(judge)  # models of bounded samples, and a table of PLACES rows
    schema = f"`{id_col}` {pairs.schema[id_col].dataType.simpleString()}, defect string"
    source = F.col(source_col) if source_col else F.lit(None).cast("string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        j = shared.value
        for batch in batches:
            found = [(i, x) for i, row in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)) for x in (j.defect(*row),) if x]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i for i, _ in found], pa.int32())), pa.array([x for _, x in found], pa.string())], names=[id_col, "defect"])

    return pairs.select(id_col, F.col(prompt_col).alias("_prompt"), F.col(response_col).alias("_response"), source.alias("_source")).mapInArrow(run, schema)


def learn_refusals(contents: list[str]) -> NaiveBayes:
    """Refusals against other texts, by the examples and texts of a bounded sample."""
    counts = {"refusal": Counter(w for t in REFUSALS for w in languages.words_of(t)), "other": Counter(w for t in contents for w in languages.words_of(t))}
    return fit(counts, ["refusal", "other"], smooth=0.02)


def learn(pairs: DataFrame, documents: DataFrame, labels: DataFrame, prompt_col: str, target: str = "pt", least: int = 3) -> PairJudge:
    """The language model from labelled documents, the end counts from all prompts, refusals from examples."""
    counted = end_counts(pairs, prompt_col).filter(F.col("seen") >= least)
    ends = {r.place: (r.ends, r.seen) for r in counted.toLocalIterator()}  # at most PLACES rows
    model, sample = learn_languages(documents, labels, target)
    return PairJudge(model, learn_refusals(sample), ends, target)
