"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

An inserted or deleted letter changes a word's letter counts by a squared
distance of one, a replaced one by two. So near words lie at most two apart,
in equal or adjacent lengths. Words are dealt to cells by how many of their
letters fall in each of a few classes (the sum is the length): an edit leads to
one of few known cells. Each cell is a block, larger ones several; products of
the count matrices of two blocks give all squared distances at once, and pairs
at most two apart are verified letter by letter. A word visits each cell that
an edit can lead to in one direction, so that every pair meets in one block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log2
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import id_and_text, shuffle_width, slices
from tallyhouse.session import written

#: Runs of ASCII letters and U+00C0 to U+00FF in UTF-8.
_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
_SECOND = b"\xc3"


class Spelling(NamedTuple):
    """Which words count, and how they are dealt.

    Words have at least ``letters`` code points and ``least`` occurrences;
    ``every`` is the share of runs that lose a letter (one in so many, 0:
    none). A block holds about ``block`` words; a task counts up to ``held``
    distinct words before it passes them on.
    """
    letters: int = 5
    least: int = 3
    every: int = 97
    block: int = 2048
    held: int = 200_000


def _shortened(run: bytes, number: int) -> bytes:
    """The run without the code point at ``number`` modulo its length."""
    text = run.decode()
    at = number % len(text)
    return (text[:at] + text[at + 1:]).encode()


def word_counts(docs: DataFrame, plan: Spelling = Spelling(), id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, for words long and frequent enough.

    A run whose number, the CRC-32 of ``<doc_id>:<run>``, is divisible by
    ``every`` loses a letter first. A null id is written as an empty string.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def out(counts: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array(counts.keys(), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                start = crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in Counter(_RUN.findall(text.lower())).items():
                    if plan.every and (number := crc32(word, start)) % plan.every == 0:
                        word = _shortened(word, number)
                    if len(word) - word.count(_SECOND) >= plan.letters:
                        counts[word] = counts.get(word, 0) + n
                if len(counts) >= plan.held:
                    yield out(counts)
                    counts = {}
        yield out(counts)

    texts = id_and_text(docs, id_column, text_column, binary=True)
    return (texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= plan.least))


def classes_for(words: int) -> int:
    """Letter classes for so many words: cells then stay small as a vocabulary grows, and a word visits some tens of them."""
    return max(2, round(log2(max(words, 2)) / 2) - 4)


def _cell(counts: list[int]) -> str:
    return ",".join(map(str, counts))


def _visits(counts: list[int]) -> Iterator[str]:
    """Cells that one edit leads to: a letter more, or one replaced by a letter of a later class."""
    for x in range(len(counts)):
        counts[x] += 1
        yield _cell(counts)
        counts[x] -= 1
    for x in range(len(counts)):
        if counts[x]:
            for y in range(x + 1, len(counts)):
                counts[x] -= 1
                counts[y] += 1
                yield _cell(counts)
                counts[x] += 1
                counts[y] -= 1


#: A word in its own cell, as the one looked for there and as one that looks; a word in another cell.
_HOME, _OWN, _GUEST = 0, 1, 2


def _dealt(words: DataFrame, classes: int) -> DataFrame:
    """Rows ``cell``, ``role``, ``word``, ``n``: every word at home and on its visits."""
    schema = pa.schema([("cell", pa.string()), ("role", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            cells, roles, source = [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                codes = np.frombuffer(word.encode("latin-1"), np.uint8)
                counts = np.bincount(codes % classes, minlength=classes).tolist()
                own = _cell(counts)
                others = list(_visits(counts))
                cells += [own, own, *others]
                roles += [_HOME, _OWN, *[_GUEST] * len(others)]
                source += [i] * (2 + len(others))
            at = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(roles, pa.int32()), batch.column("word").take(at).cast(pa.string()),
                                              batch.column("n").take(at)], schema=schema)

    return words.select("word", "n").mapInArrow(run, "cell string, role int, word string, n long")


def _tiles(dealt: DataFrame, block: int) -> DataFrame:
    """``dealt`` with the block pair ``tile`` of each row; cells without a word at home are left out.

    In a cell of several blocks, every block of words at home meets every block
    of words that look, each pair in a tile of its own.
    """
    sizes = dealt.groupBy("cell").agg(F.count_if(F.col("role") == _HOME).alias("homes"), F.count_if(F.col("role") != _HOME).alias("guests"))
    parts = lambda column: F.ceil(F.col(column) / block).cast("int")
    sizes = sizes.where("homes > 0").select("cell", parts("homes").alias("rows"), parts("guests").alias("columns"))
    drawn = F.xxhash64("word")
    row, column = F.pmod(drawn, F.col("rows")).cast("int"), F.pmod(drawn, F.col("columns")).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    tiles = F.when(F.col("role") == _HOME, F.transform(upto("columns"), lambda j: row * F.col("columns") + j)).otherwise(
        F.transform(upto("rows"), lambda i: i * F.col("columns") + column))
    return dealt.join(sizes, "cell").select("cell", F.explode(tiles).alias("tile"), "role", "word", "n")


def _codes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def _counted(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Letter counts, a row for each word and a column for each of ``letters``."""
    rows = np.repeat(np.arange(len(codes)), codes.shape[1])
    flat = np.searchsorted(letters, codes.ravel())
    return np.bincount(rows * len(letters) + flat, minlength=len(codes) * len(letters)).reshape(len(codes), -1).astype(np.float32)


def _one_replaced(longer: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (longer != other).sum(1) == 1


def _one_inserted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Equal up to some letter of ``longer`` and from the next one on."""
    def leading(equal: np.ndarray) -> np.ndarray:
        return np.where(equal.all(1), equal.shape[1], equal.argmin(1))

    return leading(longer[:, :-1] == shorter) + leading((longer[:, 1:] == shorter)[:, ::-1]) >= shorter.shape[1]


def near_in_block(homes: list[bytes], guests: list[bytes], own: np.ndarray, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Places of the near pairs between words of one length and words of the same length or one letter less.

    ``own`` marks guests at home in the same cell, which meet each home word
    twice: only the smaller word of such a pair is taken as the home word.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    length = len(homes[0])
    home_codes = _codes(homes)
    names = np.array(homes, object)
    for short in (0, 1):
        places = np.array([i for i, word in enumerate(guests) if len(word) == length - short], np.int64)
        if not len(places):
            continue
        guest_codes = _codes([guests[i] for i in places])
        letters = np.union1d(home_codes, guest_codes)
        looked, counted = _counted(home_codes, letters), _counted(guest_codes, letters)
        squares = (counted * counted).sum(1)
        for start in range(0, len(homes), rows):
            part = looked[start:start + rows]
            distance = (part * part).sum(1)[:, None] + squares - 2 * (part @ counted.T)
            a, b = np.nonzero(distance <= 2)
            a += start
            check = _one_inserted if short else _one_replaced
            right = check(home_codes[a], guest_codes[b])
            a, b = a[right], places[b[right]]
            if not short and own.any():
                twice = own[b]
                first = np.array([not t or names[x] < guests[y] for x, y, t in zip(a, b, twice)], bool)
                a, b = a[first], b[first]
            found.append((a, b))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of each tile, from rows sorted by cell and tile."""
    key, rows = None, []
    for batch in slices(batches, 4096):
        for row in batch.to_pylist():
            if (row["cell"], row["tile"]) != key:
                if rows:
                    yield rows
                key, rows = (row["cell"], row["tile"]), []
            rows.append(row)
    if rows:
        yield rows


def near_words(words: DataFrame, plan: Spelling = Spelling(), classes: int | None = None) -> DataFrame:
    """``word``, ``near``, ``near_n`` for every ordered pair of words one edit apart.

    ``words`` has distinct ``word`` and ``n``; all letters lie in Latin-1.
    """
    words = words.select("word", "n")
    dealt = written(_dealt(words, classes or classes_for(words.count())), "spelling-cells")
    tiles = _tiles(dealt, plan.block).repartition(shuffle_width(words.sparkSession), "cell", "tile").sortWithinPartitions("cell", "tile", "role")
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            homes = [r for r in rows if r["role"] == _HOME]
            guests = rows[len(homes):]
            if not homes or not guests:
                continue
            a, b = near_in_block([r["word"].encode("latin-1") for r in homes], [r["word"].encode("latin-1") for r in guests],
                                 np.array([r["role"] == _OWN for r in guests]))
            if len(a):
                pairs = [(homes[x], guests[y]) for x, y in zip(a.tolist(), b.tolist())]
                pairs += [(y, x) for x, y in pairs]
                yield pa.RecordBatch.from_arrays([pa.array([x["word"] for x, _ in pairs]), pa.array([y["word"] for _, y in pairs]),
                                                  pa.array([y["n"] for _, y in pairs], pa.int64())], schema=schema)

    return tiles.mapInArrow(run, "word string, near string, near_n long")


def _roots(forms: DataFrame, hops: int) -> DataFrame:
    """``word`` and the ``root`` its forms lead to, for words that have a form; a path's length doubles in each round."""
    reached = written(forms.select("word", F.col("form").alias("root")), "roots")
    done = 1
    while done < hops:
        further = reached.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        reached = written(reached.join(further, F.col("root") == F.col("via"), "left")
                          .select("word", F.coalesce("beyond", "root").alias("root")), "roots")
        done *= 2
    return reached


def spelling_groups(docs: DataFrame, plan: Spelling = Spelling(), id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word of ``docs``.

    The form of a word is its near word of largest ``n`` (ties: the smallest)
    if that has at least twice the word's ``n``, else null; the root is where
    the forms lead. As ``n`` doubles at every hop, the hops are few. A null
    text holds no words; rows that repeat an id count each time; an empty table
    gives no rows.
    """
    words = written(word_counts(docs, plan, id_column, text_column), "words")
    near = near_words(words, plan)
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    chosen = -F.col("best.less") >= 2 * F.col("n")
    placed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n")), "forms")
    largest = placed.agg(F.max("n").alias("n")).first()["n"] or 1
    roots = _roots(placed.where("form is not null"), int(log2(largest)) + 1)
    return placed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
