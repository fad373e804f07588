"""Toxicity (3): noisy-channel deobfuscation, then a learnt score of the restored text.

1. Character language model: trigram counts over all texts, gathered as one
   histogram per task and summed by Spark (64 folded letters, 262,144 cells),
   and 4-grams of letters without accents (32, 1,048,576 cells) for spacing.
2. Channel: a token with digits or signs among its letters, with a letter
   three times and more in a row, or spelt out as single characters, is a
   lattice: every position offers the letters it may stand for, or nothing.
   A separator between spelt characters is a position of its own, nothing or
   a word edge, so a run of them is decoded into its words.
   Viterbi decoding takes the likeliest path under the language model.
   Tokens without such marks have a one-path lattice and stay as they are.
   Tokens and runs of any length are decoded.
3. Score: on a bounded sample of labelled rows, document counts of words and
   word beginnings give each its shrunk log odds; a document's strongest
   words go into a small logistic regression, fitted on odds from other folds.
"""

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from os.path import commonprefix
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import small_batches, text_chunks, tidy
from duelframe.llm.labelled import remainder, training_rows

# The letters of the language model and the signs of the channel.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
WILD = "*#"
EDGE = "\0"                                           # a word edge in a decoded text
BETWEEN = [("", 0.0), (EDGE, 0.0)]                    # what a separator of a spelt run may stand for

TRAIN_ROWS = 20_000
MODEL_WORDS = 200_000
CACHE_WORDS = 150_000
FOLDS, MIN_TOXIC, MIN_LIFT = 4, 2, 2.0
PRIOR = 4.0                                           # pseudo documents behind each word's odds
_CODE = np.full(0x2100, 63, np.uint8)                 # 0: no letter, 63: a letter outside LETTERS
for _c in range(len(_CODE)):
    if not chr(_c).isalpha():
        _CODE[_c] = 0
for _i, _c in enumerate(LETTERS):
    _CODE[ord(_c)] = _i + 1
    if len(_c.upper()) == 1 and ord(_c.upper()) < len(_CODE):
        _CODE[ord(_c.upper())] = _i + 1
_ID = {c: i + 1 for i, c in enumerate(LETTERS)}
_PLAIN = np.full(64, 31, np.int32)                    # codes of the 4-grams: the letter without its accent
_PLAIN[0] = 0
for _i, _c in enumerate(LETTERS):
    _PLAIN[_i + 1] = _ID.get(unicodedata.normalize("NFD", _c)[0], 31) if ord(_c) > 122 else _i + 1
    if _PLAIN[_i + 1] > 26:
        _PLAIN[_i + 1] = _ID[{"ß": "s", "æ": "a", "ø": "o", "œ": "o"}[_c]]
_PLAIN_ID = {c: int(_PLAIN[i]) for c, i in _ID.items()}
_EDGE = ".,;:?!\"'()[]{}<>|*#%&~^=_/\\-–—…«»“”‘’`+"
_ODD = re.compile(r"[^\W\d_][^a-zà-ÿœ]+[^\W\d_]|(?:^|[^\W\d_])[0-9@$!|+(€£¡]+(?:[^\W\d_]|$)|([^\W\d_])\1\1")
_LETTER = re.compile(r"[^\W\d_]")
_SPELT = re.compile(r"(?<!\S)\S(?:[ ._-]\S){2,}(?!\S)")


class Model(NamedTuple):
    """Counts, or log probabilities of the last letter: of three letters, and of four with their accents off."""

    three: np.ndarray
    four: np.ndarray


def trigram_counts(docs: DataFrame, text_col: str = "text") -> Model:
    """Counts of letter trigrams and 4-grams (0: word edge) over every text, as (64, 64, 64) and (32, 32, 32, 32) arrays."""
    def run(batches):
        total, four = np.zeros(1 << 18, np.int64), np.zeros(1 << 20, np.int64)
        for batch in batches:
            for part in text_chunks(batch, "dfx_text", 1 << 20):
                joined = "\n\n".join(t for t in part.column(0).to_pylist() if t)
                for at in range(0, len(joined), 1 << 20):
                    points = np.frombuffer(joined[max(0, at - 3):at + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)
                    code = _CODE[np.minimum(points, len(_CODE) - 1)].astype(np.int32)
                    plain = _PLAIN[code]
                    four += np.bincount((plain[:-3] << 15) | (plain[1:-2] << 10) | (plain[2:-1] << 5) | plain[3:], minlength=1 << 20)
                    code = code[1:] if at else code
                    cell = (code[:-2] << 12) | (code[1:-1] << 6) | code[2:]
                    total += np.bincount(cell, minlength=1 << 18)
        total = np.concatenate([total, four])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])
        tidy()

    cells = docs.select(F.col(text_col).alias("dfx_text")).mapInArrow(run, "cell long, n long")
    got = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()      # 1,310,720 rows at most
    counts = np.zeros((1 << 18) + (1 << 20))
    counts[got["cell"].to_numpy(dtype=np.int64)] = got["n"].to_numpy()
    return Model(counts[:1 << 18].reshape(64, 64, 64), counts[1 << 18:].reshape(32, 32, 32, 32))


def _backed_off(counts: np.ndarray) -> np.ndarray:
    """P(last | those before): the longest context backed off to shorter ones."""
    one = counts.sum(axis=tuple(range(counts.ndim - 1))) + 1.0
    p = one / one.sum()
    for n in range(2, counts.ndim + 1):
        seen = counts.sum(axis=tuple(range(counts.ndim - n)))
        weight = 20.0 if n == 2 else 5.0
        p = (seen + weight * p[None]) / (seen.sum(axis=-1, keepdims=True) + weight)
    return p


def language_model(counts: Model) -> Model:
    """log P(c | a, b): trigrams backed off to bigrams and letters; 4-grams likewise."""
    return Model(*(np.log(_backed_off(c)).astype(np.float32) for c in counts))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per position, the strings it may stand for with their channel cost."""
    out, i = [], 0
    while i < len(token):
        c, j = token[i], i + 1
        while j < len(token) and token[j] == c:
            j += 1
        run = j - i
        if c.isalpha():
            if run >= 3:
                out.append([(c, 0.5), (c * 2, 1.0)])
            else:
                out.append([(c * run, 0.0)])
        elif c in WILD:
            out += [[("", 0.7), *((x, 2.0) for x in "aeiou")]] * run
        elif c in SIGNS:
            once = [(x, 0.5) for x in SIGNS[c]]
            out.append(once + [("", 8.0 if c.isdigit() else 4.0)] + ([(x * 2, 1.0) for x in SIGNS[c]] if run > 1 else []))
        else:
            out.append([("", 0.2)])
        i = j
    return out


def spelt_lattice(run: str) -> Iterator[list[tuple[str, float]]]:
    """The lattice of characters (even places of ``run``) with a separator between each two.

    Of equal characters in a row, those after the first may be left out for
    nothing, as in ``lattice``: letters from three in a row, signs from two.
    """
    chars = run[::2]
    for i, c in enumerate(chars):
        if i:
            yield BETWEEN
        if c in WILD:
            yield from lattice(c)
            continue
        again = i > 0 and chars[i - 1] == c
        if c.isalpha():
            three = (chars[max(0, i - 2):i] == c * 2) or (chars[max(0, i - 1):i + 2] == c * 3) or (chars[i:i + 3] == c * 3)
            yield ([(c, 0.5)] + ([("", 0.0)] if again else [])) if three else [(c, 0.0)]
        elif c in SIGNS and again:
            yield [(x, 0.5) for x in SIGNS[c]] + [("", 0.0)]
        else:
            yield from lattice(c)


def decode(token: str, model: Model) -> str:
    """The likeliest word behind ``token`` (lower case)."""
    return best_path(lattice(token), model.three, _ID)


def best_path(positions: Iterable[list[tuple[str, float]]], model: np.ndarray, ids: dict[str, int]) -> str:
    """The likeliest text through the positions under ``model``; word edges within it are EDGE."""
    paths = {(0,) * (model.ndim - 1): (0.0, "")}
    settled, other = [], model.shape[0] - 1
    for at, options in enumerate(chain(positions, [[(EDGE, 0.0)]]), 1):
        new: dict[tuple[int, ...], tuple[float, str]] = {}
        for before, (cost, text) in paths.items():
            for s, price in options:
                if options is BETWEEN and s and before[-1] == 0:
                    continue                               # no word without a letter
                state, total = before, cost + price
                for ch in s:
                    state = (*state, 0 if ch == EDGE else ids.get(ch, other))
                    total -= float(model[state])
                    state = state[1:]
                old = new.get(state)
                if old is None or total < old[0]:
                    new[state] = (total, text + s)
        paths = new
        if at % 64 == 0:                                   # what all paths begin with is written once
            same = len(commonprefix([text for _, text in paths.values()]))
            settled.append(next(iter(paths.values()))[1][:same])
            paths = {k: (cost, text[same:]) for k, (cost, text) in paths.items()}
    return ("".join(settled) + min(paths.values())[1]).rstrip(EDGE)


class Restorer:
    """Words of a text after restoration, with a bounded cache of decoded tokens."""

    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def token(self, token: str) -> str:
        """The restored form of one white-space token (lower case), "" if it has no letter."""
        bare = token.strip(_EDGE)
        if bare.isalpha() and not _ODD.search(bare):
            return bare
        wide = token.strip(".,;:?\"'")
        if not _LETTER.search(wide):
            return ""
        if not _ODD.search(bare if _LETTER.search(bare) else wide):
            return bare
        return decode(bare if _ODD.search(bare) else wide, self.model)

    def spelt(self, text: str) -> list[str]:
        """Words spelt out as single characters ("i d i o t")."""
        return [word for m in _SPELT.finditer(text) if _LETTER.search(m.group()) for word in self.run(m.group())]

    def run(self, run: str) -> list[str]:
        """The words of one run of single characters and separators."""
        return [word for word in best_path(spelt_lattice(run), self.model.four, _PLAIN_ID).split(EDGE) if word]

    def restored(self, text: str) -> str:
        """The whole text with its obfuscated tokens replaced (white space as it was)."""
        text = _SPELT.sub(lambda m: " ".join(self.run(m.group())) if _LETTER.search(m.group()) else m.group(), text.lower())
        return re.sub(r"\S+", lambda m: self.token(m.group()) or m.group(), text)


def word_features(word: str) -> tuple[str, ...]:
    """A word and its beginnings of four and five letters."""
    return (word, "4" + word[:4], "5" + word[:5]) if len(word) > 5 else (word, "4" + word[:4]) if len(word) == 5 else (word,)


def words_of(text: str, restorer: Restorer) -> set[str]:
    """Distinct restored words of a text."""
    lower = text.lower()
    cache, out = restorer.cache, set()
    for token in set(lower.split()):
        word = cache.get(token)
        if word is None:
            word = restorer.token(token)
            if len(cache) < CACHE_WORDS:
                cache[token] = word
        if word:
            out.add(word)
    out.update(restorer.spelt(lower))
    return out


def _summary(odds: list[float]) -> list[float]:
    """Intercept, the three strongest words, and how many are strong."""
    top = sorted(odds, reverse=True)[:3] + [0.0] * 3
    return [1.0, top[0], top[1], top[2], math.log1p(sum(o > 2.5 for o in odds))]


def fit(sample: DataFrame, model: Model) -> dict:
    """{"odds": word -> log odds, "beta": weights} from (dfx_id, dfx_y, dfx_text).

    Words are counted in FOLDS folds, and the regression sees every document
    through the words and odds of the other folds only, as it will meet new
    documents.
    """
    sample = sample.withColumn("dfx_fold", F.pmod(F.xxhash64(F.lit(7), "dfx_id"), F.lit(FOLDS)).cast("int"))
    names = ("dfx_fold", "dfx_y", "dfx_text")

    def count(batches):
        restorer, seen = Restorer(model), Counter()
        for batch in batches:
            for fold, y, text in zip(*(batch.column(c).to_pylist() for c in names)):
                seen.update({(f, fold, y) for w in words_of(text, restorer) for f in word_features(w)})
            if len(seen) > 500_000:
                yield _counts(seen)
                seen = Counter()
        yield _counts(seen)
        tidy()

    n = {r["dfx_y"]: r["count"] for r in sample.groupBy("dfx_y").count().collect()}
    if not n.get(0) or not n.get(1):
        return {"odds": {}, "beta": [-30.0, 0.0, 0.0, 0.0, 0.0]}         # nothing learned, nothing is toxic
    rate = n[1] / (n[0] + n[1])
    cells = sample.mapInArrow(count, "f string, fold int, toxic long, clean long")
    per_fold = [F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)).alias(f"{c}{k}")
                for c in ("toxic", "clean") for k in range(FOLDS)]
    table = cells.groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), *per_fold)
    lifts = [F.when(t >= MIN_TOXIC, (t + PRIOR * rate) / (t + c + PRIOR)).otherwise(0.0) for t, c in
             [(F.col("toxic"), F.col("clean"))] + [(F.col("toxic") - F.col(f"toxic{k}"), F.col("clean") - F.col(f"clean{k}")) for k in range(FOLDS)]]
    table = (table.withColumn("lift", F.greatest(*lifts)).filter(F.col("lift") > MIN_LIFT * rate)
             .orderBy(F.desc("lift"), F.desc("toxic"), "f").limit(MODEL_WORDS).toPandas())
    total = table[["toxic", "clean"]].to_numpy(dtype=np.float64)
    seen_in = table[[f"{c}{k}" for c in ("toxic", "clean") for k in range(FOLDS)]].to_numpy(dtype=np.float64)
    whole = _chosen(table["f"], total[:, 0], total[:, 1], rate)
    others = [_chosen(table["f"], total[:, 0] - seen_in[:, k], total[:, 1] - seen_in[:, FOLDS + k], rate) for k in range(FOLDS)]

    def left_out(batches):
        restorer = Restorer(model)
        for batch in batches:
            rows = []
            for fold, y, text in zip(*(batch.column(c).to_pylist() for c in names)):
                odds = [max(found) for w in words_of(text, restorer)
                        if (found := [others[fold][f] for f in word_features(w) if f in others[fold]])]
                rows.append(_summary(odds) + [float(y)])
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=list("abcdey"), dtype=float), preserve_index=False)
        tidy()

    xy = sample.mapInArrow(left_out, "a double, b double, c double, d double, e double, y double").toPandas().to_numpy()
    x, y = xy[:, :5], xy[:, 5]
    beta = np.zeros(5)
    for _ in range(25):                                   # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(5)
        beta += np.linalg.solve(hess, x.T @ (y - p) - 0.05 * beta)
    return {"odds": whole, "beta": beta.tolist()}


def _chosen(words, toxic: np.ndarray, clean: np.ndarray, rate: float) -> dict[str, float]:
    """Log odds of the words that are frequent and toxic enough by these counts."""
    p = (toxic + PRIOR * rate) / (toxic + clean + PRIOR)
    keep = (toxic >= MIN_TOXIC) & (p > MIN_LIFT * rate) & (p < 1)
    base = math.log(rate / (1 - rate))
    return dict(zip(words[keep], (np.log(p[keep] / (1 - p[keep])) - base).tolist()))


def _counts(seen: Counter) -> pa.RecordBatch:
    keys = list(seen)
    n = np.fromiter(seen.values(), np.int64, len(keys))
    y = np.array([k[2] for k in keys], np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array(n * y), pa.array(n * (1 - y))],
        names=["f", "fold", "toxic", "clean"])


def score(docs: DataFrame, model: Model, fitted: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``dfx_score``."""
    shared = docs.sparkSession.sparkContext.broadcast((model, fitted))    # 5 MB and MODEL_WORDS words at most

    def run(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(*shared.value)                 # its word cache goes with the task
        for column in columns:
            yield column.map(scorer)
        tidy()

    marked = F.pandas_udf(run, "double")
    return docs.withColumn("dfx_score", marked(F.coalesce(F.col(text_col), F.lit(""))))


class Scorer:
    def __init__(self, model: Model, fitted: dict):
        self.restorer, self.fitted = Restorer(model), fitted
        self.odds, self.beta, self.cache = fitted["odds"], fitted["beta"], {}

    def weight(self, word: str) -> float:
        odds = self.odds
        return max((odds.get(f, 0.0) for f in word_features(word)), default=0.0)

    def token(self, token: str) -> tuple[str, float] | None:
        word = self.restorer.token(token)
        w = self.weight(word) if word else 0.0
        return (word, w) if w > 0 else None

    def __call__(self, text: str) -> float:
        lower, cache, found = text.lower(), self.cache, {}
        for token in set(lower.split()):
            if token in cache:
                got = cache[token]
            else:
                got = self.token(token)
                if len(cache) < CACHE_WORDS:
                    cache[token] = got
            if got:
                found[got[0]] = got[1]
        for word in self.restorer.spelt(lower):
            if (w := self.weight(word)) > 0:
                found[word] = w
        x = _summary(list(found.values()))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, self.beta))))))


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", mod: int = 5, held: int = 0,
             train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, with ``dfx_held`` and ``dfx_score`` (0 to 1).

    Labels of held-out ids (crc32 remainder ``held``) are not read.  Null
    and empty texts are scored as texts without a word.  Without labelled
    rows of both kinds nothing can be learned: every score is 0 but for 1e-13,
    so no document counts as toxic.
    """
    small_batches(docs.sparkSession)
    model = language_model(trigram_counts(docs, text_col))
    sample = training_rows(docs, labels, label, remainder(id_col, mod) != held, train_rows, id_col, text_col)
    fitted = fit(sample.persist(), model)
    sample.unpersist()
    return score(docs, model, fitted, id_col, text_col).withColumn(
        "dfx_held", F.coalesce(remainder(id_col, mod) == held, F.lit(False)))
