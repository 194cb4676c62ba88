"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding takes compatibility forms apart (full-width and mathematical letters, accents), drops what does not show, lowers
case, maps look-alike letters of other scripts and digits or signs that stand for letters, joins letters set apart, and
turns everything else into spaces. Lexicon entries are word starts learned from labelled rows, weighted by log odds. A
hit within an exception phrase does not count; such phrases are given or learned from harmless rows that hold an entry.
The sum of weights, and that sum over the number of words, go through a logistic curve fitted on the same labelled rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field as made

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.common import arrow_input, field, held_out, score_of, text_of, written

# Letters of other scripts that look like Latin ones, and what digits and signs stand for.
HOMOGLYPHS = dict(
    zip(
        "аеорсхуіјѕһԁӏԛԝмткнвгпυαεικνορτχγωηβуɑɡıȷłøđħŧʀʏɴʟʜɢʙꜱᴀᴄᴅᴇᴊᴋᴍᴏᴘᴛᴜᴠᴡᴢ",
        "aeopcxyijshdlqwmtkhbrnuaeikvoptxywhbyagijlodhtrynlhgbsacdejkmoptuvwz",
        strict=True,
    )
)
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e"}
#: Phrases in which a lexicon word is meant harmlessly.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "garbage collection", "garbage collector", "dump truck")

FOLD = str.maketrans({**HOMOGLYPHS, **SUBSTITUTES})
UNSEEN = str.maketrans(dict.fromkeys([0xAD, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF, *range(0xFE00, 0xFE10)]))
MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff]+")
NUMBER = re.compile(r"(?<![^\W_])[\d.,:/-]*\d(?![^\W\d_])")
CALL = re.compile(r"!(?=[^\W\d_])")
NOT_LETTERS = re.compile(r"[\W\d_]+")
APART = re.compile(r"(?<= )(?:\w ){3,}")
STEM_FROM, STEM_TO = 3, 12  #: lengths of the word starts that may become entries; longer words may as a whole
SAMPLE_ROWS = 4000  #: labelled rows of each class that are learned from, at most: those with the least hashed ids
LEAST_ROWS, LEAST_ODDS = 3, math.log(12)  #: toxic rows with an entry, and its smoothed log odds, at least
AROUND, NEAR = 3, 100  #: words, within so many characters, that tell uses of an entry apart
EXCUSED_ROWS = 3  #: harmless rows with a phrase, and none toxic, that make it an exception, at least


def fold(text: str | None) -> str:
    """Folded text, words separated by single spaces, with a space before the first and after the last."""
    plain = text or ""
    if not plain.isascii():
        plain = MARKS.sub("", unicodedata.normalize("NFKD", plain.translate(UNSEEN)))
    plain = NUMBER.sub(" ", CALL.sub("i", plain.lower())).translate(FOLD)
    plain = " " + NOT_LETTERS.sub(" ", plain).strip() + " "
    return APART.sub(lambda m: m[0].replace(" ", "") + " ", plain)


@dataclass
class Lexicon:
    weights: dict[str, float]  #: by word start, folded
    slope: tuple[float, float, float] = (-3.0, 0.0, 0.0)  #: constant, of the sum of weights, of the sum per word
    exceptions: tuple[str, ...] = EXCEPTIONS
    _automaton: object = made(default=None, repr=False, compare=False)

    def automaton(self):
        import ahocorasick

        if self._automaton is None:
            found = ahocorasick.Automaton()
            for stem, weight in self.weights.items():
                found.add_word(" " + stem, (len(stem) + 1, weight))
            for phrase in self.exceptions:
                key = fold(phrase)
                found.add_word(key, (len(key), None))
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def found(self, plain: str) -> dict[int, str]:
        """Entries by place in a folded text: of those that start a word the longest counts, unless excused."""
        best: dict[int, str] = {}
        excused: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton().iter(plain):
            start = end - size + 1
            if weight is None:
                excused.append((start, end))
            else:
                best[start] = plain[start + 1 : end + 1]  # longer entries end later
        for low, high in excused:
            for start in [s for s in best if low <= s < high]:
                del best[start]
        return best

    def hits(self, text: str | None) -> tuple[float, int]:
        """(sum of weights, words)."""
        plain = fold(text)
        words = plain.count(" ") - 1 if plain.strip() else 0
        return (sum(self.weights[e] for e in self.found(plain).values()) if self.weights and words else 0.0), words

    def uses(self, text: str | None) -> set[str]:
        """Each entry found, the word that it starts, AROUND words before that one and as many after, as a line."""
        plain, out = fold(text), set()
        for start, entry in self.found(plain).items():
            end = plain.index(" ", start + 1)
            before = plain[max(0, start - NEAR) : start].split()[-AROUND:]
            after = plain[end : end + NEAR].split()[:AROUND]
            out.add("\t".join([entry, plain[start + 1 : end], " ".join(before), " ".join(after)]))
        return out

    def features(self, text: str | None) -> tuple[float, float]:
        total, words = self.hits(text)
        return math.log1p(total), math.log1p(100 * total / max(1, words))

    def score(self, text: str | None) -> float:
        x, y = self.features(text)
        a, b, c = self.slope
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def stems(text: str | None) -> set[str]:
    words = set(fold(text).split())
    return {w[:k] for w in words for k in range(STEM_FROM, min(STEM_TO, len(w)) + 1)} | {w for w in words if len(w) > STEM_TO}


def log_odds(good, bad, totals: tuple[int, int], log=math.log):
    """Smoothed log odds of a word start, from the harmless and toxic rows that hold it; numbers or columns."""
    return log((bad + 0.5) / (totals[1] + 1)) - log((good + 0.5) / (totals[0] + 1))


def surprise(good, bad, totals: tuple[int, int], log=math.log):
    """Twice the log likelihood ratio of toxic rows holding a word start more often than harmless ones do."""
    share = lambda n, total: n * log((n + 1e-9) / ((good + bad) * (total / sum(totals))))
    return 2 * (share(good, totals[0]) + share(bad, totals[1]))


def closed_entries(rows: dict[str, tuple[int, int]], totals: tuple[int, int]) -> dict[str, float]:
    """Weights of the entries to keep, from (harmless, toxic) row counts by telling word start.

    A start is dropped for a longer one that has nearly all its toxic rows, and where a shorter one is as telling.
    """
    longer: dict[str, int] = {}
    for stem in rows:
        longer[stem[:-1]] = max(longer.get(stem[:-1], 0), rows[stem][1])
    tight = {s for s in rows if longer.get(s, 0) < 0.9 * rows[s][1]}
    kept = {}
    for stem in sorted(tight, key=len):
        if not any(stem[:k] in kept and rows[stem[:k]][0] <= rows[stem][0] for k in range(STEM_FROM, min(STEM_TO + 1, len(stem)))):
            kept[stem] = round(log_odds(*rows[stem], totals), 4)
    return dict(sorted(kept.items(), key=lambda x: (-x[1], x[0])))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (constant first) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), x.T @ (y - p) - penalty @ w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return w


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold_: int, rows: int, id_col: str, text_col: str, longest: int | None = None
) -> DataFrame:
    """(text, label) of at most ``rows`` labelled rows of each class outside the held-out fold, by least hashed id.

    With ``longest``, among the rows whose texts have no more characters.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(id_col, folds, fold_)).select(id_col, F.col(label).alias("y"))
    known = known.groupBy(id_col).agg(F.max("y").alias("y"))
    texts = docs.select(id_col, text_of(text_col).alias("text"))
    if longest is not None:
        texts = texts.where(F.length("text") <= longest)
        known = known.join(texts.select(id_col), id_col, "left_semi")
    least = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(rows)
    chosen = F.broadcast(least(0).union(least(1)))  # 2 x rows ids
    return texts.join(chosen, id_col).dropDuplicates([id_col]).select("text", "y")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 5,
    fold_: int = 0,
    rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Lexicon:
    """A lexicon, its exceptions and its curve from the labelled rows outside the held-out fold.

    An entry has its odds, and is too surprising to be chance among all word starts of the sample, where uses between
    equal words, as in copies of a row, count once. Without labels there are no entries and every score is low. Null and empty texts have no words; rows with null ids are not learned from.
    """
    known = written(training_rows(docs, labels, label, folds, fold_, rows, id_col, text_col), "toxic-sample")
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    totals = totals.get(0, 0), totals.get(1, 0)

    def counts(find) -> DataFrame:
        """(name, good, bad): the harmless and toxic rows in which ``find(text)`` has a name."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [sorted(find(t)) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), batch.column(1)], names=["names", "y"])

        schema = T.StructType([T.StructField("names", T.ArrayType(T.StringType())), known.schema["y"]])
        rows_ = known.mapInArrow(run, schema).select(F.explode("names").alias("name"), "y")
        return rows_.groupBy("name").agg(F.count_if(F.col("y") == 0).alias("good"), F.count_if(F.col("y") == 1).alias("bad"))

    if not all(totals):
        return Lexicon({})
    counted = written(counts(stems), "stems")
    chance = math.log(max(2, counted.count()))
    good, bad = F.col("good"), F.col("bad")
    telling = counted.where((bad >= LEAST_ROWS) & (log_odds(good, bad, totals, F.log) >= LEAST_ODDS))
    telling = telling.where(surprise(good, bad, totals, F.log) >= chance)
    rows_by = {r["name"]: (r["good"], r["bad"]) for r in telling.collect()}
    lexicon = Lexicon(closed_entries(rows_by, totals))
    if not lexicon.weights:
        return lexicon
    part = F.split("name", "\t")
    used = counts(lexicon.uses).select(*[part[i].alias(n) for i, n in enumerate(("entry", "word", "before", "after"))], "good", "bad")
    used = written(used, "uses")  # the entries' uses within the sample
    apart = {r["entry"]: r["n"] for r in used.where(bad > 0).groupBy("entry").agg(F.count("*").alias("n")).collect()}
    seen_rows = {e: (rows_by[e][0], min(rows_by[e][1], apart.get(e, 0))) for e in lexicon.weights}  # copies of a row count once
    weights = {e: w for e, w in lexicon.weights.items() if seen_rows[e][1] >= LEAST_ROWS and surprise(*seen_rows[e], totals) >= chance}
    pairs = F.array(F.concat_ws(" ", F.substring_index("before", " ", -1), "word"), F.concat_ws(" ", "word", F.substring_index("after", " ", 1)))
    excused = used.where(F.col("entry").isin(*weights)).select(F.explode(pairs).alias("phrase"), good, bad)
    excused = excused.where(F.instr(F.trim("phrase"), " ") > 0).groupBy("phrase").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    excused = [r["phrase"] for r in excused.where((good >= EXCUSED_ROWS) & (bad == 0)).collect()]
    lexicon = Lexicon(weights, exceptions=(*EXCEPTIONS, *sorted(excused)))
    if not weights:
        return lexicon

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([lexicon.features(t) for t in batch.column(0).to_pylist()], np.float64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column(1).cast(pa.float64())], names=["a", "b", "y"])

    seen = known.mapInArrow(measure, "a double, b double, y double").toPandas()  # 2 x rows small rows
    a, b, c = logistic(seen[["a", "b"]].to_numpy(), seen["y"].to_numpy())
    lexicon.slope = float(a), float(b), float(c)
    return lexicon


def scored(df: DataFrame, lexicon: Lexicon, folds: int = 5, fold_: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of each row.

    Null and empty texts have the score of a text without hits; repeated rows have equal scores; other columns are not
    read; an empty table gives an empty result.
    """
    schema = T.StructType([field(df, id_col), T.StructField("score", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [lexicon.score(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=schema.names)

    out = arrow_input(df, id_col, text_col).mapInArrow(run, schema)
    return out.select(id_col, held_out(id_col, folds, fold_).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def harmless(df: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """The rows whose texts score under one half, with all columns, whatever their names.

    Null and empty texts score as texts without hits do; null ids and repeated rows stay or go by their texts; an empty
    table gives an empty result.
    """
    return arrow_input(df).where(score_of(lexicon.score, text_col) < 0.5)
