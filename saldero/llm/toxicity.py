"""A toxicity classifier that is held steady under swapped identity terms.

A logistic model over the presence of words, fitted on a bounded sample of the
labelled rows. Sentences that mention a group are fitted together with copies
in which the term is swapped for others of its kind, and differences between
the scores of a text and its copies are penalised, so that the mention itself
carries no weight. Every whole text is scored.

Words of the sample enter the model when their class rates differ by more than
chance explains; identity terms always do. Rows without a text, a label or an
id are not fitted; a null or empty text scores as one without words. Without
labels of both classes the model is empty, and every score lies just below 0.5.
Ties and repeated rows need no rule, a repeated label counts repeatedly. Extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import byte_slices, quoted

# Terms that name groups of people, by kind. Terms of one kind are
# swapped for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "people"),
    ("woman", "man", "girl", "boy", "person"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "refugee", "foreigner", "citizen", "resident"),
    ("immigrants", "refugees", "foreigners", "citizens", "residents"),
    ("deaf", "blind", "disabled", "autistic"),
    ("frauen", "männer", "mädchen", "jungen", "menschen"),
    ("femmes", "hommes", "filles", "garçons", "gens"),
    ("mujeres", "hombres", "niñas", "niños", "personas"),
)
KIND = {term: kind for kind in IDENTITY_TERMS for term in kind}
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows that are fitted and ``most_words`` the
    words found in them, the most telling first; all rows are scored."""

    sample: int = 8000
    least_texts: int = 4
    least_z: float = 8.0
    most_words: int = 4000
    ridge: float = 1e-5
    swap_penalty: float = 1.0
    steps: int = 300
    rate: float = 0.1


def words_of(text: str | None) -> set[str]:
    """The words of a text and, starred, the beginnings that inflected forms share."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {f"{w[:n]}*" for w in words for n in (4, 5) if len(w) > n}


def swaps(words: set[str]) -> Iterator[set[str]]:
    """The words with one identity term at a time swapped for each other one of its kind.

    The last copy has a neutral word instead that the model does not know, so
    that scores of a kind meet where no group is named, not at the highest.
    """
    for term in sorted(words & KIND.keys()):
        rest = words - words_of(term)
        for other in KIND[term]:
            if other != term:
                yield rest | words_of(other)
        yield rest


def telling_words(texts: list[set[str]], labels: np.ndarray, settings: Settings) -> list[str]:
    """Words whose share of texts differs between the classes beyond chance, and identity terms."""
    n = np.array([(labels == 0).sum(), (labels == 1).sum()], float)
    if not n.all():
        return []
    counts = [Counter(), Counter()]
    for words, label in zip(texts, labels.tolist(), strict=True):
        counts[label].update(words)
    seen = counts[0] + counts[1]
    found = []
    for word, total in seen.items():
        if total < settings.least_texts:
            continue
        share = total / n.sum()
        spread = np.sqrt(share * (1 - share) * (1 / n).sum())
        apart = abs(counts[1][word] / n[1] - counts[0][word] / n[0])
        if spread and apart / spread > settings.least_z:
            found.append((-apart / spread, word))
    chosen = {word for _, word in sorted(found)[: settings.most_words]}
    for term in seen.keys() & KIND.keys():
        chosen.update(*map(words_of, KIND[term]))
    return sorted(chosen)


def _matrix(texts: list[set[str]], index: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(texts), len(index) + 1), np.float32)
    x[:, -1] = 1
    for row, words in zip(x, texts, strict=True):
        row[[index[w] for w in words if w in index]] = 1
    return x


def fit(texts: list[set[str]], labels: np.ndarray, settings: Settings) -> dict[str, float]:
    """Weight per word; the empty word is the constant.

    The loss is the mean log loss, plus the mean squared difference of the
    scores of a text and its swapped copies, plus a ridge on the weights.
    """
    vocabulary = telling_words(texts, labels, settings)
    if not vocabulary:
        return {}
    index = {w: i for i, w in enumerate(vocabulary)}
    x, y = _matrix(texts, index), labels.astype(np.float32)
    # a swap changes the score by the words that go and come, so equal ones count together
    swapped = Counter(
        (frozenset(words - copy), frozenset(copy - words)) for words in texts for copy in swaps(words)
    )
    change = _matrix([set(b) for _, b in swapped], index) - _matrix([set(a) for a, _ in swapped], index)
    share = np.array(list(swapped.values()), np.float32) / max(1, swapped.total())
    weights = np.zeros(x.shape[1], np.float32)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, settings.steps + 1):
        p = 1 / (1 + np.exp(-(x @ weights)))
        slope = x.T @ (p - y) / len(y) + settings.ridge * weights * (np.arange(len(weights)) < len(index))
        slope += settings.swap_penalty * 2 * change.T @ (share * (change @ weights))
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        weights = weights - settings.rate * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.999**step)) + 1e-8
        )
    return dict(zip([*vocabulary, ""], weights.tolist(), strict=True))


def learn(
    df: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    settings: Settings = Settings(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> dict[str, float]:
    """Weights from at most ``settings.sample`` labelled rows that satisfy ``may_learn``.

    The sample is spread by a hash of the id. It is fitted in one task, and only
    the weights of the chosen words reach the driver.
    """
    usable = labels.where(may_learn & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    chosen = (
        usable.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(settings.sample)
    )
    # no more rows than the sample has, whatever the labels grow to
    texts = df.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    sample = texts.join(F.broadcast(chosen), "id").select("id", "label", "text")

    def to_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [" ".join(sorted(words_of(t.as_py()))) for t in batch.column(2)]
            columns = [*batch.columns[:2], pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "words"])

    def in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # in one order, whichever task delivered first
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        found = fit([set(r[2].split()) for r in rows], np.array([r[1] for r in rows], int), settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.float64())],
            names=["word", "weight"],
        )

    words = sample.mapInArrow(to_words, "id long, label int, words string")
    model = words.repartition(1).mapInArrow(in_one_task, "word string, weight double")
    return {r["word"]: r["weight"] for r in model.collect()}


def score(
    df: DataFrame,
    weights: dict[str, float],
    *,
    keep: list[str],
    text_col: str = "text",
    score_col: str = "score",
) -> DataFrame:
    """The columns ``keep`` and the score of every row's whole text.

    Only the text goes to Python, and only the score comes back. A kept column
    with the name of ``score_col`` gives way to the score.
    """
    numbered = {w: i for i, w in enumerate(w for w in weights if w)}
    by_word = np.array([weights[w] for w in numbered], float)
    # an empty model has no opinion and rejects nothing
    constant = weights.get("", -1e-9)

    def scores(texts: pa.Array) -> np.ndarray:
        split = pc.utf8_split_whitespace(texts.cast(pa.large_string()))
        offsets = split.offsets.to_numpy().astype(np.int64)
        tokens = split.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        encoded = tokens.dictionary_encode()
        known = [
            [numbered[w] for w in words_of(token) if w in numbered]
            for token in encoded.dictionary.to_pylist()
        ]
        telling = np.array([bool(k) for k in known], bool)
        codes = encoded.indices.to_numpy()
        places = np.flatnonzero(telling[codes])
        owners = np.searchsorted(offsets - offsets[0], places, side="right") - 1
        pairs = {
            (owner, w)
            for owner, code in zip(owners.tolist(), codes[places].tolist(), strict=True)
            for w in known[code]
        }
        total = np.full(len(texts), constant)
        for owner, w in sorted(pairs):
            total[owner] += by_word[w]
        return 1 / (1 + np.exp(-total))

    @F.arrow_udf("double")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            batch = pa.record_batch([texts], names=["text"])
            found = [scores(rows.column(0)) for rows in byte_slices(batch, 0)]
            yield pa.array(np.concatenate([np.zeros(0), *found]), pa.float64())

    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    kept = [F.col(quoted(c)) for c in keep if c.lower() != score_col.lower()]
    return df.select(*kept, scored(text).alias(score_col))
