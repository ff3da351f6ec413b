"""Language identification by interpolated Kneser-Ney models of characters.

One model of order four per language, over lower-case letters with every run
of other characters as one space. All languages share one table per order: a
sorted array of n-gram hashes beside a matrix of log-probabilities, one column
per language, with unseen n-grams of a language already backed off. A text
then costs one binary search per character for all languages together; only
n-grams that no language has seen are looked up again one order lower. The
language with the lowest cross-entropy per character wins. Scores and the
limit beyond which a text is rejected are calibrated on labelled documents
that were left out of training.

Training takes all labelled documents. The model, which is broadcast, holds
each distinct n-gram of letters once: it grows with the letters that occur
together, not with the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyhouse.llm.common import slices
from tallyhouse.session import written

ORDER = 4
UNKNOWN = "und"
_SPACE = 32
_AT_ONCE = 1 << 17
#: Characters whose n-grams are counted together before they leave a task.
_COUNTED_AT_ONCE = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Beyond this length a text's cross-entropy no longer comes closer to its language's mean.
_STEADY = 400


class Order(NamedTuple):
    """N-grams of one order and the contexts one shorter, both sorted by hash."""
    grams: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


class Model(NamedTuple):
    """Orders from one up; ``floor`` is the log-probability of a character never seen."""
    languages: list[str]
    orders: list[Order]
    floor: np.ndarray
    temperature: float
    mean: np.ndarray
    limit: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: the lower-case letter's code point, or a space."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for code in range(0x110000):
        character = chr(code)
        if character.isalpha():
            table[code] = ord(character.lower()[0])
    return table


def letters_of(text: str) -> np.ndarray:
    """Codes of a text with context in front: ``ORDER - 1`` spaces, then no two spaces in a row."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    codes = _letters()[raw]
    if len(codes):
        space = codes == _SPACE
        keep = ~space
        keep[1:] |= ~space[:-1]
        keep[0] = not space[0]
        codes = codes[keep]
    return np.concatenate([np.full(ORDER - 1, _SPACE, np.uint32), codes])


def _hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` codes that end at each position from ``ORDER - 1`` on."""
    n = len(codes) - ORDER + 1
    found = np.zeros(n, np.uint64)
    for back in range(order - 1, -1, -1):
        start = ORDER - 1 - back
        found = (found + codes[start:start + n].astype(np.uint64) + np.uint64(1)) * _MIX
        found ^= found >> np.uint64(29)
    return found


def _fold(columns: list[np.ndarray]) -> np.ndarray:
    """The same hash for n-grams given as columns of codes."""
    found = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        found = (found + column.astype(np.uint64) + np.uint64(1)) * _MIX
        found ^= found >> np.uint64(29)
    return found


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def log_probabilities(model: Model, codes: np.ndarray) -> np.ndarray:
    """One row per character, one column per language."""
    n, width = len(codes) - ORDER + 1, len(model.languages)
    found = np.empty((n, width), np.float32)
    carried = np.zeros((n, width), np.float32)
    todo = np.arange(n)
    for order in range(ORDER, 0, -1):
        table = model.orders[order - 1]
        hashes = _hashes(codes, order)
        at, hit = _find(table.grams, hashes[todo] if len(todo) < n else hashes)
        done = todo[hit]
        found[done] = table.logp[at[hit]]
        if order < ORDER:
            found[done] += carried[done]
        todo = todo[~hit]
        if not len(todo):
            return found
        context = np.zeros(n, np.uint64)
        for back in range(order - 1, 0, -1):
            start = ORDER - 1 - back
            context = (context + codes[start:start + n].astype(np.uint64) + np.uint64(1)) * _MIX
            context ^= context >> np.uint64(29)
        at, hit = _find(table.contexts, context[todo])
        carried[todo[hit]] += table.backoff[at[hit]]
    found[todo] = model.floor + carried[todo]
    return found


def _sums(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: log-probability in each language, characters scored, letters."""
    totals = np.zeros((len(texts), len(model.languages)))
    lengths, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    pieces: list[tuple[int, np.ndarray]] = []
    waiting = 0

    def flush() -> None:
        nonlocal waiting
        if not pieces:
            return
        # Each piece brings its own context, whose positions are scored as well and dropped.
        codes = np.concatenate([piece for _, piece in pieces])
        logp = log_probabilities(model, codes).astype(np.float64)
        at = 0
        for index, piece in pieces:
            n = len(piece) - ORDER + 1
            totals[index] += logp[at:at + n].sum(axis=0)
            at += len(piece)
        pieces.clear()
        waiting = 0

    for index, text in enumerate(texts):
        codes = letters_of(text)
        lengths[index] = len(codes) - ORDER + 1
        letters[index] = int(np.count_nonzero(codes[ORDER - 1:] != _SPACE))
        if not letters[index]:
            continue
        for start in range(0, int(lengths[index]), _AT_ONCE):
            piece = codes[start:start + _AT_ONCE + ORDER - 1]
            pieces.append((index, piece))
            waiting += len(piece)
            if waiting >= _AT_ONCE:
                flush()
    flush()
    return totals, lengths, letters


def _estimate(grams: dict[str, tuple[np.ndarray, np.ndarray]], languages: list[str]) -> tuple[list[Order], np.ndarray]:
    """Tables from each language's distinct n-grams of the highest order (rows of codes) and their counts."""
    symbols = len(np.unique(np.concatenate([codes[:, -1] for codes, _ in grams.values()]))) + 1
    # counts[k][language]: n-grams of order k + 1 with their counts, below the highest order of distinct predecessors.
    counts: list[dict] = [{} for _ in range(ORDER)]
    for language, (codes, number) in grams.items():
        counts[ORDER - 1][language] = (codes, number.astype(np.float64))
        for order in range(ORDER - 1, 0, -1):
            longer = counts[order][language][0]
            shorter, predecessors = np.unique(longer[:, 1:], axis=0, return_counts=True)
            counts[order - 1][language] = (shorter, predecessors.astype(np.float64))
    orders: list[Order] = []
    floor = np.zeros(len(languages), np.float32)
    for order in range(1, ORDER + 1):
        union = np.unique(np.concatenate([counts[order - 1][x][0] for x in languages]), axis=0)
        hashes = _fold(list(union.T))
        rank = np.argsort(hashes)
        union, hashes = union[rank], hashes[rank]
        contexts = np.unique(_fold(list(union[:, :-1].T)) if order > 1 else np.zeros(1, np.uint64))
        own_context = np.searchsorted(contexts, _fold(list(union[:, :-1].T)) if order > 1
                                      else np.zeros(len(union), np.uint64))
        if order > 1:
            below, known = _find(orders[-1].grams, _fold(list(union[:, 1:].T)))
            lower = np.where(known[:, None], np.exp(orders[-1].logp[below].astype(np.float64)), np.exp(floor)[None, :])
        else:
            lower = np.full((len(union), len(languages)), 1 / symbols)
        logp = np.empty((len(union), len(languages)), np.float32)
        backoff = np.zeros((len(contexts), len(languages)), np.float32)
        for column, language in enumerate(languages):
            codes, number = counts[order - 1][language]
            once, twice = np.count_nonzero(number == 1), np.count_nonzero(number == 2)
            discount = min(max(once / (once + 2 * twice) if once else 0.5, 0.05), 0.95)
            at = np.searchsorted(hashes, _fold(list(codes.T)))
            seen = np.zeros(len(union))
            seen[at] = number
            total = np.bincount(own_context, seen, len(contexts))
            kinds = np.bincount(own_context, seen > 0, len(contexts))
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            share = np.maximum(seen - discount, 0) / np.maximum(total, 1)[own_context]
            logp[:, column] = np.log(share + weight[own_context] * lower[:, column])
            backoff[:, column] = np.log(weight)
            if order == 1:
                floor[column] = np.log(weight[0] / symbols)
        # The backoff of order one is part of the floor.
        orders.append(Order(hashes, logp, contexts, backoff if order > 1 else np.zeros_like(backoff)))
    return orders, floor


def _share_of(sample: Column) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    return (F.xxhash64(sample.cast("string"), F.lit("language sample")).bitwiseAND(F.lit((1 << 40) - 1))) / float(1 << 40)


def _distinct_grams(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of the highest order (rows of codes) in texts of codes, and their counts."""
    codes = np.concatenate([*texts, np.full(ORDER - 1, _SPACE, np.uint32)])
    begins = np.ones(len(codes) - ORDER + 1, bool)
    ends = np.cumsum(list(map(len, texts)))
    for back in range(1, ORDER):  # no n-gram goes on into the next text
        begins[ends - back] = False
    at = np.flatnonzero(begins)
    letters, ranks = np.unique(codes, return_inverse=True)
    if len(letters) > 1 << 16:
        return np.unique(codes[at[:, None] + np.arange(ORDER)], axis=0, return_counts=True)
    packed = np.zeros(len(at), np.uint64)
    for i in range(ORDER):
        packed = packed << np.uint64(16) | ranks[at + i].astype(np.uint64)
    packed, number = np.unique(packed, return_counts=True)
    shifts = np.arange(ORDER - 1, -1, -1, dtype=np.uint64) * np.uint64(16)
    return letters[(packed[:, None] >> shifts & np.uint64(0xFFFF)).astype(np.int64)], number


def train(labelled: DataFrame, calibration: float = 0.2, id_column: str = "doc_id",
          text_column: str = "text", lang_column: str = "lang", few: int = 40) -> Model | None:
    """The model of all languages in ``labelled``; rows without id, text or language are left out.

    ``calibration`` is the share of rows, drawn by a hash of the ids, that sets
    score and rejection and is not trained on; a language with fewer than
    ``few`` rows is trained on all of them, has no share there and rejects
    nothing. None if there is nothing to learn from.
    """
    rows = labelled.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"),
                           F.col(lang_column).cast("string").alias("lang")).dropna()
    sizes = {row.lang: row.n for row in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    # Of very few rows all might fall into the calibration share, and the language would be lost.
    held = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, calibration if n >= few else -1.0)))
    rows = rows.withColumn("held", _share_of(F.col("doc_id")) <= held[F.col("lang")])
    grams_schema = pa.schema([("lang", pa.string()), *((f"c{i}", pa.int32()) for i in range(ORDER)), ("n", pa.int64())])

    def counts_of(waiting: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, texts in waiting.items():
            grams, number = _distinct_grams(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), *(pa.array(c.astype(np.int32)) for c in grams.T),
                 pa.array(number.astype(np.int64))], schema=grams_schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0
        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                codes = letters_of(text)
                waiting.setdefault(lang, []).append(codes)
                size += len(codes)
                if size >= _COUNTED_AT_ONCE:
                    yield from counts_of(waiting)
                    waiting, size = {}, 0
        yield from counts_of(waiting)

    names = [f"c{i}" for i in range(ORDER)]
    trained = rows.where("not held").select("lang", "text")
    counted = (trained.mapInArrow(count, "lang string, " + ", ".join(f"{c} int" for c in names) + ", n long")
               .groupBy("lang", *names).agg(F.sum("n").alias("n")))
    frame = counted.toPandas()  # the model itself: the distinct n-grams of each language
    grams = {lang: (part[names].to_numpy(np.uint32), part["n"].to_numpy()) for lang, part in frame.groupby("lang")}
    languages = sorted(grams)
    if not languages:
        return None
    orders, floor = _estimate(grams, languages)
    width = len(languages)
    draft = Model(languages, orders, floor, 1.0, np.zeros(width), np.full(width, np.inf))
    return _calibrated(draft, rows.where("held").select("lang", "text"))


def _calibrated(draft: Model, held: DataFrame) -> Model:
    """Temperature of the score by least log-loss; mean and limit of each language's cross-entropy.

    Entropies are measured once and stored; only sums and maxima, a row for
    each temperature or language, leave the tasks.
    """
    shared = held.sparkSession.sparkContext.broadcast(draft)
    schema = pa.schema([("truth", pa.int32()), ("n", pa.int64()), ("entropy", pa.list_(pa.float64()))])
    temperatures = 2.0 ** np.arange(-6, 6.25, 0.25)
    languages = draft.languages

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            totals, lengths, letters = _sums(shared.value, batch.column("text").to_pylist())
            truth = np.array([languages.index(x) if x in languages else -1 for x in batch.column("lang").to_pylist()])
            some = np.flatnonzero((letters > 0) & (truth >= 0))
            entropy = -totals[some] / lengths[some, None]
            yield pa.RecordBatch.from_arrays([pa.array(truth[some], pa.int32()), pa.array(lengths[some]),
                                              pa.array(entropy.tolist(), pa.list_(pa.float64()))], schema=schema)

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(temperatures))
        for batch in slices(batches, 4096):
            truth, n = batch.column("truth").to_numpy(), batch.column("n").to_numpy()
            entropy = np.array(batch.column("entropy").to_pylist())
            lead = (entropy.min(axis=1, keepdims=True) - entropy) * np.sqrt(n)[:, None]
            for i, temperature in enumerate(temperatures):
                scaled = lead * temperature
                total[i] -= (scaled[np.arange(len(n)), truth] - np.log(np.exp(scaled).sum(axis=1))).sum()
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(total)), pa.int32()), "loss": pa.array(total)})

    measured = written(held.mapInArrow(measure, "truth int, n long, entropy array<double>"), "entropies")
    steady = F.sqrt(F.least(F.col("n"), F.lit(_STEADY)).cast("double"))
    # The language itself does best: of equally good ones the first counts.
    own = (measured.where(F.array_position("entropy", F.array_min("entropy")) == F.col("truth") + 1)
           .select("truth", F.get("entropy", F.col("truth")).alias("entropy"), steady.alias("steady")))
    if measured.isEmpty():
        return draft
    loss = {row["at"]: row["loss"] for row in measured.mapInArrow(losses, "at int, loss double").groupBy("at").agg(F.sum("loss").alias("loss")).collect()}
    mean, limit = np.zeros(len(languages)), np.full(len(languages), np.inf)
    for row in own.groupBy("truth").agg((F.sum(F.col("entropy") * F.col("steady")) / F.sum("steady")).alias("mean")).collect():
        mean[row.truth] = round(row["mean"], 9)  # whatever order the tasks were added in
    centre = F.get(F.array(*map(F.lit, mean.tolist())), F.col("truth"))
    for row in own.groupBy("truth").agg(F.max((F.col("entropy") - centre) * F.col("steady")).alias("most")).collect():
        # Three times as far as the farthest calibration document: only what is unlike all of them goes.
        limit[row.truth] = 3 * max(row["most"], 1.0)
    return draft._replace(temperature=float(temperatures[min(loss, key=lambda at: (loss[at], at))]), mean=mean, limit=limit)


def identify(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_accepted``; nothing but the text is looked at.

    A null text or one without a letter is ``und`` with score 0 and is not
    accepted, as is every text if there is no model. A text in which no
    language does well keeps its best language but is not accepted. Columns of
    ``docs`` with these three names are replaced. Rows do not move between
    tasks; repeated rows get the same answer each.
    """
    names = ["lang_pred", "lang_score", "lang_accepted"]
    docs = docs.drop(*names)
    if model is None:
        return docs.withColumns({names[0]: F.lit(UNKNOWN), names[1]: F.lit(0.0), names[2]: F.lit(False)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            texts = [text or "" for text in batch.column(text_column).to_pylist()]
            totals, lengths, letters = _sums(model, texts)
            n = np.maximum(lengths, 1)
            entropy = -totals / n[:, None]
            best = entropy.argmin(axis=1)
            lowest = entropy[np.arange(len(texts)), best]
            scaled = np.exp((lowest[:, None] - entropy) * np.sqrt(n)[:, None] * model.temperature)
            some = letters > 0
            score = np.where(some, 1 / scaled.sum(axis=1), 0.0)
            accepted = some & ((lowest - model.mean[best]) * np.sqrt(np.minimum(n, _STEADY)) <= model.limit[best])
            predicted = [model.languages[b] if s else UNKNOWN for b, s in zip(best, some)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(predicted), pa.array(score), pa.array(accepted)],
                names=[*batch.schema.names, *names])

    added = [T.StructField(name, kind) for name, kind in zip(names, (T.StringType(), T.DoubleType(), T.BooleanType()))]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def held_out(id_column: str = "doc_id", folds: int = 5) -> Column:
    """True for the fold that training must not see: ids whose CRC-32 is a multiple of ``folds``."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds == 0, F.lit(False))
