"""Secret scans: character Markov models of random strings and of ordinary identifiers.

Three patterns give the base spans. The method adds spans of kind ``random``:
every run of letters and digits, which is a part of a path, an address or a
name, is scored by the log-likelihood ratio of two first-order Markov chains
over characters, one trained on samples labelled random, one on ordinary
identifiers. Scan and training are column expressions; training counts the
words of all documents, then their pairs of characters, and only the two
tables of pairs, whose size the alphabet bounds, pass through the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

#: The base patterns, and what a match needs beyond its pattern.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_TOKEN = "[A-Za-z0-9+/_=-]"
#: What is scored: names and paths fall apart at all other characters.
_PART = "[A-Za-z0-9]"
_BLOCK = 256


class Markov(NamedTuple):
    """Log-likelihood ratio of each pair of characters, row by row, and the sum that makes a secret."""
    ratios: list[float]
    threshold: float
    least: int


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, even if ``use`` names it inside loops."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running_sums(numbers: Column) -> Column:
    """Inclusive running sums of an array, block by block, so that long arrays do not cost their square."""
    add = lambda a, b: a + b
    zero = F.lit(0).cast("long")

    def of(values: Column) -> Column:
        n = F.size(values)
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")),
                             lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))
        return _once(blocks, lambda cut: _once(
            F.transform(cut, lambda block: F.aggregate(block, zero, add)),
            lambda totals: F.flatten(F.transform(cut, lambda block, k: _once(
                F.aggregate(F.slice(totals, F.lit(1), k), zero, add),
                lambda base: F.transform(block, lambda _, i: base + F.aggregate(
                    F.slice(block, F.lit(1), i + 1), zero, add)))))))

    return F.when(F.size(numbers) == 0, F.array().cast("array<bigint>")).otherwise(_once(numbers, of))


def _spans(text: Column, pattern: str, kind: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Array of (start, kind number, end) of the pattern's matches that ``keep`` accepts, in code points."""
    number = F.lit(KINDS.index(kind))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def of(matches: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        steps = F.zip_with(F.transform(gaps, F.length),
                           F.concat(F.array(F.lit(0)), F.transform(matches, F.length)), lambda gap, before: (gap + before).cast("long"))
        # One gap more than matches: the step after the last match is not a start.
        placed = _once(F.slice(steps, F.lit(1), F.size(matches)), lambda s: F.zip_with(
            _running_sums(s), matches, lambda start, match: F.struct(
                start.alias("start"), number.alias("kind"), (start + F.length(match)).alias("end"), match.alias("match"))))
        kept = F.filter(placed, lambda s: keep(s["match"])) if keep else placed
        return F.transform(kept, lambda s: F.struct(s["start"], s["kind"], s["end"]))

    return _once(found, lambda matches: F.when(F.size(matches) == 0, empty).otherwise(of(matches)))


def base_spans(text: Column) -> Column:
    """Assignments, access keys and hex runs: array of (start, kind number, end).

    Runs shorter than a pattern's least length cannot hide a longer match, so
    the least lengths of access and hex are part of the patterns. A failing
    assignment does use up its text, so its least length is checked afterwards.
    """
    long_enough = lambda match: F.length(F.regexp_extract(match, f"^{ASSIGN}$", 2)) >= ASSIGN_LEAST
    return F.concat(_spans(text, ASSIGN, "assign", long_enough), _spans(text, ACCESS, "access"), _spans(text, HEX, "hex"))


def ratio(token: Column, model: Markov) -> Column:
    """Log-likelihood ratio of a token of characters in ``ALPHABET``, random over ordinary."""
    width = len(ALPHABET)
    table = F.from_json(F.lit(json.dumps(model.ratios)), "array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return _once(codes, lambda code: F.aggregate(
        F.zip_with(F.slice(code, F.lit(1), F.size(code) - 1), F.slice(code, F.lit(2), F.size(code) - 1),
                   lambda a, b: F.element_at(table, (a - 1) * width + b)), F.lit(0.0), lambda a, b: a + b))


def all_spans(text: Column, model: Markov | None) -> Column:
    """Base spans and the method's, by start, then kind in the order of ``KINDS``."""
    found = base_spans(text)
    if model:
        found = F.concat(found, _spans(text, f"{_PART}{{{model.least},}}", "random",
                                       lambda match: ratio(match, model) > model.threshold))
    return F.array_sort(found)


def _chain(counts: dict[str, int], single: float) -> dict[str, float]:
    """Logarithm of the probability of each character after each, mixed with a share of its own frequency.

    A pair that other languages use and the sample does not is so no less
    likely than its second character allows.
    """
    width = len(ALPHABET)
    total = sum(counts.values())
    alone = {b: (sum(counts.get(a + b, 0) for a in ALPHABET) + 1) / (total + width) for b in ALPHABET}
    found = {}
    for a in ALPHABET:
        after = sum(counts.get(a + b, 0) for b in ALPHABET)
        for b in ALPHABET:
            found[a + b] = math.log((1 - single) * (counts.get(a + b, 0) + alone[b]) / (after + 1) + single * alone[b])
    return found


def train(labelled: DataFrame, prior: float = 1e-6, single: float = 0.2) -> Markov | None:
    """Two chains from ``labelled`` rows (token string, random boolean, and ``n`` where one stands for several); None without rows of both kinds.

    ``prior`` is the share of random strings expected among tokens and sets
    the threshold, ``single`` the weight of characters by themselves. The
    shortest part that is scored follows from the threshold: as long as random
    strings are that reach twice the threshold on average.
    """
    times = F.col("n") if "n" in labelled.columns else F.lit(1)
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring("token", i, F.lit(2))))
    counted = (labelled.where(F.length("token") > 1).select("random", pair.alias("pair"), times.alias("n"))
               .where(F.col("pair").rlike(f"^{_TOKEN}{{2}}$")).groupBy("random", "pair").agg(F.sum("n").alias("n")))
    counts = {True: {}, False: {}}
    for row in counted.where("random is not null").collect():  # at most two tables of pairs over the alphabet
        counts[row.random][row.pair] = row.n
    if not counts[True] or not counts[False]:
        return None
    chains = {side: _chain(counts[side], single) for side in counts}
    gains = {pair: chains[True][pair] - chains[False][pair] for pair in chains[True]}
    seen = {pair: n for pair, n in counts[True].items() if pair.isalnum()} or counts[True]
    gain = sum(n * gains[pair] for pair, n in seen.items()) / sum(seen.values())
    threshold = math.log(1 / prior)
    return Markov([gains[a + b] for a in ALPHABET for b in ALPHABET], threshold, 1 + math.ceil(2 * threshold / max(gain, 0.1)))


#: In small letters, what every assignment holds: a quicker look than the pattern's.
_NAMED = ("passw", "secret", "token", "apikey", "api_key")


def _named(text: Column, then: Column, otherwise: Column) -> Column:
    """``then`` where the text may hold an assignment."""
    return F.when(reduce(or_, (F.contains(F.lower(text), F.lit(name)) for name in _NAMED)), then).otherwise(otherwise)


def _ordinary(texts: DataFrame) -> DataFrame:
    """Runs of letters and digits, and the names made of every three of a text (AbcDefGhi, abcDefGhi and ABC): tokens with their number.

    A name is counted by its words and by the two characters where words meet
    (after a plus sign), so that equal words of all texts are one row before
    they are written as names write them.
    """
    word, number, n, leads = map(F.col, ("word", "number", "n", "leads"))
    letter = lambda of, at: F.substring(of, at, F.lit(1))
    runs = texts.select(F.regexp_extract_all("text", F.lit(f"{_PART}{{2,}}"), F.lit(0)).alias("runs"))
    # Outer: otherwise the plan looks for the runs a second time, to leave out texts without any.
    words = runs.select("runs", F.posexplode_outer("runs").alias("number", "word"))
    met = F.when(number % 3 > 0, F.concat(F.lit("+"), letter(F.get("runs", number - 1), F.lit(-1)), letter(word, F.lit(1))))
    counted = (words.select((number % 3 == 0).alias("leads"), F.explode(F.array(word, met)).alias("word")).where("word is not null")
               .groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_if("leads").alias("leads")))
    form = lambda token, times: F.struct(F.lit(False).alias("random"), token.alias("token"), times.alias("n"))
    titled = F.concat(F.upper(letter(word, F.lit(1))), F.lower(F.substring(word, F.lit(2), F.length(word))))
    joint = F.concat(F.lower(letter(word, F.lit(2))), F.upper(letter(word, F.lit(3))))
    return counted.select(F.inline(F.when(word.startswith("+"), F.array(form(joint, 2 * n))).otherwise(F.array(
        form(word, n), form(titled, 2 * n - leads), form(F.lower(word), leads), form(F.upper(word), leads))))).where("n > 0")


def labelled_tokens(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Samples for ``train`` from all documents: ``token``, whether it is ``random``, and for how many it stands (``n``).

    Ordinary is what the scan meets outside the base patterns' matches: runs of
    letters and digits, and names made of them as programs do, with inner or
    all capitals. Random are the values that the base patterns point at, and
    for each document a digest of its own, in base 64, in its capitals and in
    hexadecimal digits.
    """
    own = F.xxhash64(F.col(id_column).cast("string"), F.lit("secret sample")).bitwiseAND(F.lit((1 << 40) - 1))
    texts = docs.select(F.col(text_column).alias("text"), own.cast("string").alias("own")).where("text is not null")
    text = F.col("text")
    values = F.concat(
        _named(text, F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_LEAST),
               F.array().cast("array<string>")),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    digest = F.sha2(F.concat("own", "text"), 256)
    alone = F.regexp_replace(F.base64(F.unhex(digest)), "[^A-Za-z0-9]", "")
    random = texts.select(F.lit(True).alias("random"), F.explode_outer(F.concat(
        values, F.array(alone, F.upper(alone), F.sha2(digest, 256)))).alias("token"), F.lit(1).cast("long").alias("n"))
    rest = F.regexp_replace(F.regexp_replace(_named(text, F.regexp_replace("text", ASSIGN, " "), text), ACCESS, " "), HEX, " ")
    return random.unionByName(_ordinary(texts.select(rest.alias("text"))))


def scan_secrets(docs: DataFrame, model: Markov | None, text_column: str = "text") -> DataFrame:
    """``docs`` with ``secret_spans``, an array of (start, kind number, end); a null or empty text has none.

    Repeated rows get the same spans each; a column of that name is replaced;
    no row moves between tasks.
    """
    return docs.withColumn("secret_spans", all_spans(F.coalesce(F.col(text_column), F.lit("")), model))


def redacted(scanned: DataFrame, text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """``scanned`` with every span of the text replaced by ``mark``, overlapping ones by one mark.

    A null text stays null. ``secret_spans`` goes.
    """
    text = F.col(text_column)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        before = F.concat(F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int")), F.lit(mark))
        parts = F.when(span["start"] >= state["at"], F.concat(state["parts"], F.array(before))).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), parts.alias("parts"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    clean = F.when(F.size("secret_spans") > 0, F.aggregate("secret_spans", start, step, finish)).otherwise(text)
    return scanned.withColumn(text_column, clean).drop("secret_spans")
