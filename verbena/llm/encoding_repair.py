"""Garbled text from a wrong character encoding: found and restored by learned mappings.

Learning. Every text is cut into phrases (a few words in a row). Phrases that agree once all
non-ASCII characters are stripped are near-twins: the most frequent one of a skeleton is the
anchor, the others are compared with it. Where too few letters are left of a phrase to tell
it by, as in other scripts, its twin is the phrase that it would have been before one of the
encodings tried. Twins are aligned character by character: each run of non-ASCII characters
of one stands for the run of the other, and every transformation (an encoding that was
written, one that it was read in, and how often that happened in a row) that turns the run
of the commoner characters into the other gets a vote for each character of the run. A
transformation is accepted if it explains enough different characters and enough occurrences.

Counts are made over all records and over distinct texts, so copies of a garbled text can't
hide it. Only votes by character and transformation, and counts by character, reach the
driver: both are bounded by the number of characters there are.

Applying. Multi-byte mappings are applied to every record, with or without a twin; a run must
decode to characters that are common in the data. For single bytes the restored character
must be far commoner between its neighbours than the one that stands there; so must the
character that a lone lead begins whose follower was lost, being a space or a sign that shows
nothing; and a lost character gets the one that stands nearly always between its neighbours.
These substitutions are worked out once, by joins of the table of contexts with itself, and
only those that hold are kept. They are sent to the workers if there are at most `most` of
them, and joined to the records' contexts otherwise, with the same result. Replacement
characters and C1 controls that no mapping takes are garbled in any case, restorable or not.

Null and empty texts and pure ASCII are never garbled. Repeated rows are judged alike, each
for itself. Texts are processed whole. Extra columns play no part.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship, stored

#: Encodings tried: what a text was written in, and what it was read in.
WRITTEN = ("utf-8", "latin-1", "cp1252")
READ = ("cp1252", "latin-1", "mac_roman", "cp850", "cp437", "cp1250", "cp1251", "cp1254", "iso8859_15", "iso8859_2", "cp852", "cp866", "koi8_r")
RUN = re.compile(r"[^\x00-\x7f]+")
#: ASCII white space alone parts words: a no-break space may be half of a garbled character.
BLANKS = re.compile(r"[ \t\n\r\x0b\x0c\x1c-\x1f]+")
LOST = re.compile("[�\x80-\x9f]")
#: Entries that a partition's counter holds before it hands them on.
FLUSH = 200_000


@cache
def byte_table(name: str) -> list[str]:
    """The character that an encoding shows for each byte; undefined bytes show as themselves."""
    return [bytes([b]).decode(name, "ignore") or chr(b) for b in range(256)]


@dataclass(frozen=True)
class Transformation:
    """Text written in one encoding and read in another, `times` times over."""

    written: str
    read: str
    times: int = 1

    def garble(self, text: str) -> str | None:
        table = byte_table(self.read)
        for _ in range(self.times):
            try:
                text = "".join(table[b] for b in text.encode(self.written))
            except UnicodeEncodeError:
                return None
        return text


    def undo(self, text: str) -> str | None:
        """What the text was if every run of it was garbled in this way; null if one can't have been."""
        back = {c: b for b, c in enumerate(byte_table(self.read)) if b >= 128}
        for _ in range(self.times):
            try:
                text = RUN.sub(lambda m: bytes(back[c] for c in m.group()).decode(self.written), text)
            except (KeyError, UnicodeDecodeError):
                return None
        return text


@cache
def candidates() -> list[Transformation]:
    single = [Transformation(w, r) for w in WRITTEN for r in READ if w != r and {w, r} != {"latin-1", "cp1252"}]
    return single + [Transformation("utf-8", r, 2) for r in READ]


def pairs_of_runs(a: str, b: str) -> list[tuple[str, str]]:
    """The runs of non-ASCII characters of two texts with one skeleton, side by side, where they differ."""
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        x, y = RUN.match(a, i), RUN.match(b, j)
        if x or y:
            left, right = x.group() if x else "", y.group() if y else ""
            if left != right:
                out.append((left, right))
            i, j = i + len(left), j + len(right)
        else:
            i, j = i + 1, j + 1
    return out


def phrases(text: str, words: int) -> Iterator[str]:
    parts = [p for p in BLANKS.split(text) if p]
    if len(parts) <= words:
        yield " ".join(parts)
    for i in range(len(parts) - words + 1):
        yield " ".join(parts[i : i + words])


COUNTS = pa.schema([("kind", pa.string()), ("a", pa.string()), ("b", pa.string()), ("c", pa.string()), ("n", pa.int64()), ("d", pa.int64())])
COUNTS_DDL = "kind string, a string, b string, c string, n long, d long"


def _letter(c: str) -> str:
    """A neighbour as the context knows it: digits are alike, the end of the text is a space."""
    return "0" if c.isdigit() else " " if not c or c.isspace() else c


def contexts_of(text: str) -> Iterator[tuple[int, tuple[str, str, str]]]:
    """Each non-ASCII character's place, and the character between its neighbours."""
    last = len(text) - 1
    for m in RUN.finditer(text):
        for i in range(m.start(), m.end()):
            yield i, (_letter(text[i - 1] if i else ""), text[i], _letter(text[i + 1] if i < last else ""))


def counted(texts: DataFrame, keys_of: Callable[[str], Iterable[tuple[str, str, str, str]]], purpose: str) -> DataFrame:
    """kind, a, b, c, n, d: how often each key stands in all texts, and in distinct ones; summed in partitions first.

    `texts` has a distinct text with its copies.
    """

    def rows(copies: Counter, once: Counter) -> pa.RecordBatch:
        keys = list(once)
        numbers = (pa.array([counter[k] for k in keys], pa.int64()) for counter in (copies, once))
        return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.string()) for i in range(4)), *numbers], schema=COUNTS)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies: Counter = Counter()
        once: Counter = Counter()
        for batch in batches:
            for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for key in keys_of(text):
                    copies[key] += n
                    once[key] += 1
                    if len(once) > FLUSH:
                        yield rows(copies, once)
                        copies.clear()
                        once.clear()
        if once:
            yield rows(copies, once)

    return stored(texts.mapInArrow(count, COUNTS_DDL).groupBy("kind", "a", "b", "c").agg(F.sum("n").alias("n"), F.sum("d").alias("d")), purpose)


def phrase_keys(words: int, least: int) -> Callable[[str], Iterator[tuple[str, str, str, str]]]:
    """Each non-ASCII character, and each different phrase: by its skeleton, or on its own where that has fewer than `least` letters."""

    def keys(text: str) -> Iterator[tuple[str, str, str, str]]:
        for m in RUN.finditer(text):
            for c in m.group():
                yield "char", c, "", ""
        for phrase in set(phrases(text, words)):
            if not phrase.isascii():
                skeleton = RUN.sub("", phrase)
                yield ("phrase", skeleton, phrase, "") if sum(map(str.isalpha, skeleton)) >= least else ("weak", "", phrase, "")

    return keys


@dataclass
class Repair:
    """What was learned: accepted transformations, the common characters, and the substitutions of single characters
    (before, there, after) -> restored, as a dictionary or, where there are too many, as a table (a, b, c, restored)."""

    transformations: list[Transformation]
    common: set[str]
    substitutions: dict[tuple[str, str, str], str] = field(default_factory=dict)
    table: DataFrame | None = None
    _ready: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_ready": {}, "table": None}

    def _multi(self):
        if "multi" not in self._ready:
            multi = []
            for t in self.transformations:
                if t.written == "utf-8":
                    back = {c: b for b, c in enumerate(byte_table(t.read)) if b >= 128}
                    multi.append((t, back, re.compile("[" + re.escape("".join(back)) + "]+")))
            self._ready["multi"] = sorted(multi, key=lambda m: -m[0].times)
        return self._ready["multi"]

    def singles(self) -> list[tuple[str, str, int]]:
        """There, restored and rank of each character that a single-byte mapping or a lost follower may have put there."""
        out: dict[tuple[str, str], int] = {}
        for t in self.transformations:
            if t.written == "utf-8":
                for lead, d in self._leads(t) if t.times == 1 else ():
                    out.setdefault((lead, d), len(out))
            else:
                shown = byte_table(t.written)
                for b, c in enumerate(byte_table(t.read)):
                    if b >= 128 and shown[b] != c and shown[b] in self.common:
                        out.setdefault((c, shown[b]), len(out))
        return [(c, d, rank) for (c, d), rank in out.items()]

    def _leads(self, t: Transformation) -> Iterator[tuple[str, str]]:
        """Leads whose follower shows as a space or as nothing, so that it was likely lost, with the common character they begin."""
        shown = byte_table(t.read)
        for d in sorted(self.common):
            data = d.encode("utf-8")
            if len(data) == 2 and (shown[data[1]].isspace() or unicodedata.category(shown[data[1]]) in ("Cf", "Cc")):
                yield shown[data[0]], d

    def _decode(self, run: str, back: dict[str, int], times: int) -> str | None:
        """The run with every sequence that decodes to common characters put right; None if there is none."""
        data = bytes(back[c] for c in run)
        out, i, hit = [], 0, False
        while i < len(data):
            for n in (4, 3, 2):
                piece = data[i : i + n]
                if len(piece) == n:
                    try:
                        c = piece.decode("utf-8")
                    except UnicodeDecodeError:
                        continue
                    if len(c) == 1 and (c in self.common or times > 1):
                        out.append(c)
                        i, hit = i + n, True
                        break
            else:
                out.append(run[i])
                i += 1
        return "".join(out) if hit else None

    def _fix(self, run: str) -> str:
        """A run of non-ASCII characters with each multi-byte mapping taken back in turn; kept for the next time."""
        new = run
        for t, back, runs in self._multi():
            restored = new
            for step in range(t.times):
                rest = t.times - step
                changed = runs.sub(lambda m: self._decode(m.group(), back, rest) or m.group(), restored)  # noqa: B023
                if changed == restored:
                    restored = new
                    break
                restored = changed
            new = restored
        self._ready["runs"][run] = new
        return new

    def fixed(self, text: str) -> str:
        """The text with all multi-byte mappings taken back."""
        runs = self._ready.setdefault("runs", {})
        if len(runs) > FLUSH:
            runs.clear()
        return RUN.sub(lambda m: runs.get(m.group()) or self._fix(m.group()), text)

    def restore(self, text: str, at: dict[int, str] | None = None) -> tuple[str, bool]:
        """The text restored as far as possible, and whether it was garbled; `at` has the substitutions by place, if they were joined."""
        fixed = self.fixed(text)
        if at is None and self.substitutions and not fixed.isascii():
            at = {i: d for i, key in contexts_of(fixed) if (d := self.substitutions.get(key)) is not None}
        if at:
            out = list(fixed)
            for i, d in at.items():
                out[i] = d
            return "".join(out), True
        return fixed, fixed != text or bool(LOST.search(fixed))


def votes(repair_of: dict[str, int], twice: dict[str, int], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """clean, garbled, mask, n: characters of aligned runs, and the candidates, a bit each, that explain the whole run."""
    tried = candidates()
    known: dict[tuple[str, str], list[tuple[str, str, int]]] = {}
    counter: Counter = Counter()

    def explained(clean: str, garbled: str) -> list[tuple[str, str, int]]:
        # the clean run holds the commoner characters, by one of the counts
        if not clean or not any(min(f.get(c, 0) for c in clean) > min((f.get(c, 0) for c in garbled), default=0) for f in (repair_of, twice)):
            return []
        by: dict[tuple[str, str], int] = defaultdict(int)
        for bit, t in enumerate(tried):
            if t.garble(clean) == garbled:
                for c in set(clean):
                    by[c, t.garble(c)] |= 1 << bit
        return [(c, g, mask) for (c, g), mask in by.items()]

    def rows() -> pa.RecordBatch:
        keys = list(counter)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.int64()), pa.array([counter[k] for k in keys], pa.int64())], names=["clean", "garbled", "mask", "n"])

    for batch in batches:
        for phrase, anchor, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            for pair in pairs_of_runs(phrase, anchor):
                found = known.get(pair)
                if found is None:
                    if len(known) > FLUSH:
                        known.clear()
                    found = known[pair] = explained(*pair) + explained(*pair[::-1])
                for key in found:
                    counter[key] += n
        if len(counter) > FLUSH:
            yield rows()
            counter.clear()
    if counter:
        yield rows()


def infer(found: list[tuple[str, str, int, int]], least_characters: int, least_count: int) -> list[Transformation]:
    """The transformations with enough votes (clean, garbled, mask, n), among them some that no accepted one has."""
    explains: dict[Transformation, Counter] = {t: Counter({(c, g): 0 for c, g, mask, _ in found if mask >> bit & 1}) for bit, t in enumerate(candidates())}
    for bit, t in enumerate(candidates()):
        for c, g, mask, n in found:
            if mask >> bit & 1:
                explains[t][c, g] += n
    enough = {t: h for t, h in explains.items() if len(h) >= least_characters and sum(h.values()) >= least_count}
    accepted: list[Transformation] = []
    settled: set[tuple[str, str]] = set()
    while enough:
        fresh = {t: sum(n for p, n in h.items() if p not in settled) for t, h in enough.items()}
        best = max(enough, key=lambda t: fresh[t])
        if fresh[best] < 2:
            break
        accepted.append(best)
        settled |= set(enough.pop(best))
    return accepted


def substitutions(contexts: DataFrame, repair: Repair, support: int, ratio: float) -> DataFrame:
    """a, b, c, restored: the characters b that are replaced between a and c.

    The one restored must stand there `support` times and `ratio` times as often as b, in all
    records or in distinct texts; a single occurrence of b is no evidence for it. For a lost
    character it is the one that makes up nine tenths of what stands there.
    """
    spark = contexts.sparkSession
    pairs = spark.createDataFrame(repair.singles(), "b string, restored string, rank int")  # bounded by the bytes of the encodings tried
    there = contexts.join(F.broadcast(pairs), "b")
    want = contexts.select("a", F.col("b").alias("restored"), "c", F.col("n").alias("_n"), F.col("d").alias("_d"))
    much = lambda w, t: (F.col(w) >= support) & (F.col(w) >= ratio * F.when(F.col(t) > 1, F.col(t)).otherwise(0))
    commoner = there.join(want, ["a", "restored", "c"]).filter(much("_n", "n") | much("_d", "d"))
    singles = commoner.groupBy("a", "b", "c").agg(F.min_by("restored", "rank").alias("restored"))

    gone = F.col("b").rlike("[\ufffd\\x{80}-\\x{9f}]")
    holes = contexts.filter(gone).select("a", "b", "c").distinct()
    around = contexts.filter(~gone).join(holes.select("a", "c").distinct(), ["a", "c"], "left_semi")
    nearly = lambda n: F.when((F.max(n) >= support) & (F.max(n) >= 0.9 * F.sum(n)), F.max_by("b", n))
    once = F.when(F.col("d") > 1, F.col("d"))
    likely = around.groupBy("a", "c").agg(F.coalesce(nearly(once), nearly(F.when(F.col("n") > 1, F.col("n")))).alias("restored")).filter("restored is not null")
    lost = holes.join(likely, ["a", "c"]).join(singles, ["a", "b", "c"], "left_anti")
    return singles.unionByName(lost.select("a", "b", "c", "restored"))


def learn(
    texts: DataFrame, text_col: str = "text", words: int = 2, least: int = 4, least_characters: int = 3, least_count: int = 4, support: int = 5, ratio: float = 8.0, most: int = 500_000
) -> Repair:
    """Learn from all texts; `texts` may hold clean records that needn't be judged themselves."""
    spark = texts.sparkSession
    ship(spark)
    wanted = texts.select(F.col(text_col).alias("_text")).filter(F.col("_text").rlike(r"[^\x00-\x7F]"))
    distinct = stored(wanted.groupBy("_text").agg(F.count("*").alias("_n")), "texts")
    keys = counted(distinct, phrase_keys(words, least), "phrases")
    characters = [(r.a, r.n, r.d) for r in keys.filter("kind = 'char'").select("a", "n", "d").collect()]  # a row for each character in use
    frequency, of_texts = {c: n for c, n, _ in characters}, {c: d for c, _, d in characters}

    found = keys.filter("kind = 'phrase'").select(F.col("a").alias("skeleton"), F.col("b").alias("phrase"), "n", "d")
    rank = F.struct(F.col("d"), F.col("n"), -F.length("phrase"), F.col("phrase"))
    anchors = found.groupBy("skeleton").agg(F.max_by("phrase", rank).alias("anchor"), F.count("*").alias("_k")).filter("_k > 1").drop("_k")
    twins = found.join(anchors, "skeleton").filter("phrase <> anchor").select("phrase", "anchor", "n")
    weak = keys.filter("kind = 'weak'").select(F.col("b").alias("phrase"), "n")

    def undone(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tried = [t for t in candidates() if t.written == "utf-8"]
        for batch in batches:
            rows = [(p, q, n) for p, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for q in {t.undo(p) for t in tried} if q is not None and q != p]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["phrase", "anchor", "n"])

    before = weak.mapInArrow(undone, "phrase string, anchor string, n long").join(weak.select(F.col("phrase").alias("anchor")), "anchor").select("phrase", "anchor", "n")
    counts = spark.sparkContext.broadcast((frequency, of_texts))
    said = twins.unionByName(before).mapInArrow(lambda batches: votes(*counts.value, batches), "clean string, garbled string, mask long, n long").groupBy("clean", "garbled", "mask").agg(F.sum("n").alias("n"))
    transformations = infer([tuple(r) for r in said.collect()], least_characters, least_count)  # bounded by the characters in use and the candidates
    repair = Repair(transformations, {c for c, n in frequency.items() if n >= 3 and not LOST.match(c)})

    mended = spark.sparkContext.broadcast(repair)
    contexts = counted(distinct, lambda text: (("context", *key) for _, key in contexts_of(mended.value.fixed(text))), "contexts")
    table = stored(substitutions(contexts, repair, support, ratio), "substitutions")
    if table.count() <= most:
        repair.substitutions = {(r.a, r.b, r.c): r.restored for r in table.collect()}
    else:
        repair.table = table
    return repair


def garbled_records(records: DataFrame, repair: Repair, text_col: str = "text") -> DataFrame:
    """The garbled records, with `restored` and whether no lost character is left in it."""
    spark = records.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(repair)  # mappings, characters, and a checked number of substitutions
    kept = [c for c in records.columns if c not in ("restored", "restorable")]
    types = [f"`{c}` {records.schema[c].dataType.simpleString()}" for c in kept]
    rows = records.select(*[F.col(f"`{c}`") for c in kept]).filter(F.col(f"`{text_col}`").rlike(r"[^\x00-\x7F]"))
    joined = repair.table is not None

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(kept.index(text_col)).to_pylist()
            at = [{x["i"]: x["d"] for x in y or ()} for y in batch.column(len(kept)).to_pylist()] if joined else [None] * len(texts)
            found = [(i, r) for i, (t, places) in enumerate(zip(texts, at, strict=True)) for r, bad in (model.restore(t, places),) if bad]
            taken = batch.take(pa.array([i for i, _ in found], pa.int32()))
            restored = [r for _, r in found]
            columns = [*taken.columns[: len(kept)], pa.array(restored, pa.string()), pa.array([not LOST.search(r) for r in restored], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "restored", "restorable"])

    def sites(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = [(n, i, *key) for n, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, key in contexts_of(model.fixed(t))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()))], names=["_n", "i", "a", "b", "c"])

    if joined:
        rows = stored(rows.withColumn("_n", F.monotonically_increasing_id()), "records")
        places = rows.select("_n", F.col(f"`{text_col}`")).mapInArrow(sites, "_n long, i int, a string, b string, c string").join(repair.table, ["a", "b", "c"])
        by_row = places.groupBy("_n").agg(F.collect_list(F.struct("i", F.col("restored").alias("d"))).alias("_at"))  # as many as a text has characters
        rows = rows.join(by_row, "_n", "left").select(*[F.col(f"`{c}`") for c in kept], "_at")
    return rows.mapInArrow(judge, ", ".join(types) + ", restored string, restorable boolean")
