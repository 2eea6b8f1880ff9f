"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding: lower case, compatibility forms, look-alike letters of other scripts and digits or signs that
stand for letters replaced; accents stay, as they tell words of many languages apart. 1, l, | and ! all fold to i, in texts and lexicon
alike. Characters without width are dropped. What is left between letters and their marks is one space.

An entry is a whole word (`` word ``) or the beginning of one (`` stem``). A match doesn't count where
an exception phrase covers it. The counted weights, over the text's length and in sum, give the
score through a logistic curve.

``learn`` finds the lexicon in labelled documents: entries far commoner in toxic ones; of entries that
begin alike, another one must explain documents that those before it do not. Phrases in which
entries occur in harmless documents become exceptions. All counts are made in Spark over the training sample.

Defined cases: null, empty and letterless texts have no match and get the score of no match. Without
toxic and harmless labels the lexicon is empty and every score is 0. Rows are scored one by one, so
repeated rows repeat and null ids stay. Other columns pass through ``scored`` untouched.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from waybill.llm.labelled import logistic, training_sample
from waybill.llm.tables import forget, keep, remembered, small_batches
from waybill.llm.words import row_chunks

# fixed values: letters of other scripts that look like Latin ones, signs and digits used for letters
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѡ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɡ": "g", "ʟ": "i", "ѵ": "v", "ո": "n", "ս": "u", "օ": "o",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "|": "i", "!": "i", "l": "i",
}


def _weightless(character: str) -> bool:
    """Format characters and variation selectors take no room: words go on across them."""
    return unicodedata.category(character) == "Cf" or "\ufe00" <= character <= "\ufe0f"


class _Once(dict):
    """A table for ``str.translate`` that works a character out when it is first met."""

    def __init__(self, of):
        self.of = of

    def __missing__(self, code: int):
        found = self[code] = self.of(chr(code))
        return found


_NO_WIDTH = _Once(lambda c: None if _weightless(c) else c)
_FOLD = _Once(lambda c: LOOK_ALIKES.get(c) or (c if unicodedata.category(c)[0] in "LM" else " "))
_SIGNS = re.compile(r"[!|$@]+(?![^\W_])")  # where they end a word
STEMS = range(3, 10)


def fold_text(text: str | None) -> str:
    """`` word word `` of the folded text, with a space at both ends; one space if there is no word."""
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_NO_WIDTH)
    # a sign that ends a word is punctuation, within or before letters it stands for one
    words = " ".join(_SIGNS.sub(" ", text).translate(_FOLD).split())
    return f" {words} " if words else " "


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)  # entries as folded, with their spaces
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] | None = None

    def matcher(self):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            automaton.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            if phrase not in self.weights:
                automaton.add_word(phrase, (len(phrase), None))
        automaton.make_automaton()
        return automaton


def counted(folded: str, automaton) -> tuple[float, int]:
    """Weight of the counted matches, and the number of words."""
    words = folded.count(" ") - 1
    if not len(automaton):
        return 0.0, words
    found, excused = {}, []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            excused.append((start, end))
        elif weight > found.get(start, (0.0, 0))[0]:  # of entries that begin alike the heaviest counts
            found[start] = (weight, end)
    total = sum(w for start, (w, end) in found.items()
                if not any(a <= start and end <= b for a, b in excused))
    return total, words


def _features(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.column_stack([np.log1p(100 * total / np.maximum(words, 20)), np.log1p(total)])


def terms(folded: str) -> set[str]:
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:k]}" for k in STEMS if k < len(word))
    return found


def _folded(sample: DataFrame) -> DataFrame:
    """Stored (text, y) with folded texts, as they are read several times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("toxicity")
        for whole in batches:
            for batch in row_chunks(whole, "text"):
                texts = [fold_text(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("y")], ["text", "y"])

    return keep(sample.select("text", "y").mapInArrow(run, "text string, y int"), "folded")


def _lists(folded: DataFrame, make) -> DataFrame:
    """(y, found): what the function that ``make`` returns, once a task, finds in each folded text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("toxicity")
        find = make()
        for whole in batches:
            for batch in row_chunks(whole, "text"):
                found = [sorted(find(t)) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.string()))], ["y", "found"])

    return folded.mapInArrow(run, "y int, found array<string>")


def _surprise(toxic: int, clean: int, share: float) -> float:
    parts = ((toxic, share), (clean, 1 - share))
    return 2 * sum(k * np.log(k / ((toxic + clean) * p)) for k, p in parts if k)


def learn(sample: DataFrame, support: float = 0.01, purity: float = 0.5, surprise: float = 24.0, size: int = 200) -> Lexicon:
    """A lexicon of at most ``size`` entries from a training sample (text, y).

    An entry must occur in ``support`` of the toxic documents, and at least ``purity`` of the documents
    that hold it, but none of the chosen entries that begin like it, must be toxic. Its rate among
    them must be beyond chance: ``surprise`` is the least log-likelihood ratio against all documents.
    """
    sample = _folded(sample)
    totals = {row["y"]: row["count"] for row in sample.groupBy("y").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Lexicon()
    least = max(3, int(support * toxic))
    often = (
        _lists(sample.filter("y = 1"), lambda: terms)
        .select(F.explode("found").alias("term")).groupBy("term").count().filter(F.col("count") >= least)
        .select("term").collect()
    )  # at most (terms in the sample) / least rows
    wanted = sample.sparkSession.sparkContext.broadcast({row["term"] for row in often})
    seen = _lists(sample, lambda: lambda text: terms(text) & wanted.value)
    rates = seen.select("y", F.explode("found").alias("term")).groupBy("term").agg(
        F.sum("y").alias("t"), F.count("*").alias("n")).filter(F.col("t") >= F.col("n") * 0.3)
    rate = {r["term"]: (r["t"], r["n"]) for r in rates.collect()}
    named = sample.sparkSession.sparkContext.broadcast(set(rate))
    docs = [(r["y"], set(r["found"])) for r in _lists(
        sample, lambda: lambda text: terms(text) & named.value).filter(F.size("found") > 0).collect()]
    holders: dict[str, list[set[int]]] = {}
    for i, (y, found) in enumerate(docs):
        for term in found:
            holders.setdefault(term, [set(), set()])[y].add(i)
    weights: dict[str, float] = {}

    def worth(term: str):  # of equals the whole word, then the longer one
        t, n = rate[term]
        return t * (t / (n + 1)) ** 2, term.endswith(" "), len(term), term

    for term in sorted(holders, key=worth, reverse=True):
        clean_in, toxic_in = holders[term]
        for other in weights:
            if other.startswith(term.rstrip()) or term.startswith(other.rstrip()):
                clean_in, toxic_in = clean_in - holders[other][0], toxic_in - holders[other][1]
        if len(toxic_in) >= least and _surprise(len(toxic_in), len(clean_in), toxic / (toxic + clean)) >= surprise \
                and len(toxic_in) >= purity * (len(toxic_in) + len(clean_in)):
            t, n = rate[term]
            weights[term] = float(np.log((t + 0.5) / (toxic + 1)) - np.log((n - t + 0.5) / (clean + 1)))
        if len(weights) == size:
            break
    lexicon = Lexicon({k: w for k, w in weights.items() if w > 0})
    lexicon.exceptions = _exceptions(sample, lexicon)
    rows = _apply(sample, "text", ["total", "words"], lambda: _totals(lexicon), fold=None).select("total", "words", "y").collect()
    forget(sample)
    total, words, y = (np.array([r[i] for r in rows], float) for i in range(3))
    lexicon.curve = tuple(map(float, logistic(_features(total, words), y)))
    return lexicon


def _exceptions(sample: DataFrame, lexicon: Lexicon, least: int = 3) -> list[str]:
    """Whole words and word pairs around matches that are toxic in no more than a fifth of cases;
    all that occur in ``least`` texts, so the sample's bound is theirs."""
    def make():
        matcher = lexicon.matcher()

        def phrases(text: str) -> set[str]:
            found = set()
            for end, (length, _) in matcher.iter(text) if len(matcher) else ():
                start = end - length + 1
                stop = text.index(" ", max(end, start + 1))
                before, after = text.rfind(" ", 0, max(start, 0)), text.find(" ", stop + 1)
                found.add(text[start : stop + 1])
                if before >= 0:
                    found.add(text[before : stop + 1])
                if after >= 0:
                    found.add(text[start : after + 1])
            return found
        return phrases

    counts = _lists(sample, make).select("y", F.explode("found").alias("phrase")).groupBy("phrase").agg(
        F.sum("y").alias("t"), F.count("*").alias("n"))
    rows = counts.filter((F.col("n") >= least) & (F.col("t") * 5 <= F.col("n"))).select("phrase").collect()
    return sorted(r["phrase"] for r in rows)


def _apply(df: DataFrame, text: str, names: list[str], make, fold=fold_text) -> DataFrame:
    """``df`` with double columns that the function ``make`` returns computes from folded texts."""
    schema = StructType(df.schema.fields + [StructField(n, DoubleType()) for n in names])
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("toxicity")
        state = make()
        for whole in batches:
            for batch in row_chunks(whole, place):
                texts = batch.column(place).to_pylist()
                columns = state([fold(t) for t in texts] if fold else texts)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.float64()) for c in columns)],
                                                 [*batch.schema.names, *names])

    return df.mapInArrow(run, schema)


def _totals(lexicon: Lexicon):
    automaton = lexicon.matcher()
    return lambda texts: tuple(zip(*(map(float, counted(t, automaton)) for t in texts))) or ((), ())


def scored(docs: DataFrame, lexicon: Lexicon, name: str = "score") -> DataFrame:
    """``docs`` with column ``name``: 0 to 1, higher for likelier toxic. A column of that name is replaced."""
    docs = docs.drop(name)
    def make():
        automaton = lexicon.matcher()

        def score(texts: list[str]):
            if lexicon.curve is None or not texts:
                return (np.zeros(len(texts)),)
            pairs = np.array([counted(t, automaton) for t in texts], float)
            x = _features(pairs[:, 0], pairs[:, 1])
            a, b, c = lexicon.curve
            return (1 / (1 + np.exp(-np.clip(a * x[:, 0] + b * x[:, 1] + c, -50, 50))),)
        return score

    return _apply(docs, "text", [name], make)


def toxicity_model(docs: DataFrame, labels: DataFrame, learn_from: Column, bound: int = 20_000) -> Lexicon:
    """A lexicon learned from about ``bound`` labelled documents at most."""
    sample = training_sample(docs, labels, "toxic", learn_from, bound)
    with small_batches(docs.sparkSession):
        return learn(sample)
