"""Token-sorted name similarity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.binding import let
from rollcall.functions.texts import strip
from rollcall.settings import NAME_SIMILARITY

# Longest text whose matching positions fit one long with room for a carry.
WORD = 62


def sorted_tokens(name: Column) -> Column:
    """Lower-cased words in sorted order, joined by one space."""
    words = F.filter(F.split(F.lower(strip(name)), r"\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def first_letter_block(name: Column) -> Column:
    """First letter of the lower-cased name, ``#`` for anything but a letter, null for a blank name."""
    lowered = F.lower(strip(name))
    letter = F.substring(lowered, 1, 1)
    return F.when(lowered != "", F.when(letter.rlike(r"^\p{L}"), letter).otherwise("#"))


def _letters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _lcs_by_bits(a: Column, b: Column) -> Column:
    """Bit-parallel: one long holds the open places of ``a``, one step per letter of ``b``."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def bit(place: Column) -> Column:
        return F.call_function("shiftleft", one, place)

    def masks_of(letters: Column) -> Column:
        def places(letter: Column) -> Column:
            bits = F.transform(letters, lambda c, i: F.when(c == letter, bit(i)).otherwise(zero))
            return F.aggregate(bits, zero, lambda total, x: total + x)

        return F.map_from_entries(F.transform(F.array_distinct(letters), lambda c: F.struct(c, places(c))))

    def open_places(masks: Column, whole: Column) -> Column:
        def step(open_bits: Column, letter: Column) -> Column:
            hit = open_bits.bitwiseAND(F.coalesce(F.try_element_at(masks, letter), zero))
            return (open_bits + hit).bitwiseOR(open_bits - hit).bitwiseAND(whole)

        return F.aggregate(_letters(b), whole, step)

    masks = let(_letters(a), masks_of)
    rest = let(masks, lambda m: let(bit(F.length(a)) - one, lambda whole: open_places(m, whole)))
    return F.length(a) - F.bit_count(rest)


def _lcs_by_words(a: Column, b: Column) -> Column:
    """The same for an ``a`` of any length: its places fill several longs, and each step carries from one to the next."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    full = F.lit((1 << WORD) - 1)

    def words_of(letters: Column) -> Column:
        return F.sequence(F.lit(0), F.ceil(F.size(letters) / F.lit(WORD)).cast("int") - 1)

    def sums(letters: Column, counts) -> Column:
        """Per word the bits of the places that count."""

        def word(w: Column) -> Column:
            part = F.slice(letters, w * WORD + 1, F.lit(WORD))
            bits = F.transform(part, lambda c, i: F.when(counts(c), F.call_function("shiftleft", one, i)).otherwise(zero))
            return F.aggregate(bits, zero, lambda total, x: total + x)

        return F.transform(words_of(letters), word)

    def masks_of(letters: Column) -> Column:
        return F.map_from_entries(F.transform(F.array_distinct(letters), lambda c: F.struct(c, sums(letters, lambda x: x == c))))

    def open_places(letters: Column, masks: Column) -> Column:
        whole = sums(letters, lambda x: F.lit(True))

        def step(words: Column, letter: Column) -> Column:
            own = F.try_element_at(masks, letter)

            def word(state: Column, w: Column) -> Column:
                value = F.get(words, w)
                hit = value.bitwiseAND(F.get(own, w))
                total = value + hit + state["carry"]
                rest = total.bitwiseAND(full).bitwiseOR(value - hit).bitwiseAND(F.get(whole, w))
                return F.struct(F.concat(state["done"], F.array(rest)).alias("done"), F.call_function("shiftright", total, F.lit(WORD)).alias("carry"))

            start = F.struct(F.array().cast("array<bigint>").alias("done"), zero.alias("carry"))
            moved = F.aggregate(words_of(letters), start, word, lambda state: state["done"])
            return F.when(own.isNull(), words).otherwise(moved)

        return F.aggregate(_letters(b), whole, step)

    rest = let(_letters(a), lambda letters: let(masks_of(letters), lambda masks: open_places(letters, masks)))
    return F.length(a) - F.aggregate(rest, F.lit(0), lambda total, x: total + F.bit_count(x))


def _shared_start(a: Column, b: Column) -> Column:
    """How many letters two lists have in common from the start."""
    return let(
        F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)),
        lambda same: F.when(F.array_position(same, F.lit(False)) > 0, F.array_position(same, F.lit(False)).cast("int") - 1).otherwise(F.size(same)),
    )


def _without_ends(a: Column, b: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
    """``body`` of two texts without the letters they share at both ends, and of how many those are."""

    def cut(letters: Column) -> Column:
        a, b = letters["a"], letters["b"]

        def inner(start: Column) -> Column:
            rest = F.struct(F.slice(a, start + 1, F.size(a) - start).alias("a"), F.slice(b, start + 1, F.size(b) - start).alias("b"))

            def whole(rest: Column) -> Column:
                left = lambda side, end: F.array_join(F.slice(rest[side], F.lit(1), F.size(rest[side]) - end), "")
                return let(_shared_start(F.reverse(rest["a"]), F.reverse(rest["b"])), lambda end: body(left("a", end), left("b", end), start + end))

            return let(rest, whole)

        return let(_shared_start(a, b), inner)

    return let(F.struct(_letters(a).alias("a"), _letters(b).alias("b")), cut)


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts. Shared ends are part of it, so only what is between them is searched."""
    return _without_ends(a, b, lambda x, y, ends: ends + F.when((x == "") | (y == ""), 0).otherwise(_common_length(x, y)))


def _common_length(a: Column, b: Column) -> Column:
    """The same for texts that are not empty. The shorter one is the one kept in bits."""
    a_first = F.length(a) <= F.length(b)
    short, long = F.when(a_first, a).otherwise(b), F.when(a_first, b).otherwise(a)

    def measured(pair: Column) -> Column:
        fits = F.length(pair["short"]) <= WORD
        return F.when(fits, _lcs_by_bits(pair["short"], pair["long"])).otherwise(_lcs_by_words(pair["short"], pair["long"]))

    return let(F.struct(short.alias("short"), long.alias("long")), measured)


def indel_distance(a: Column, b: Column) -> Column:
    """Letters to delete and insert to turn one text into the other."""
    return F.length(a) + F.length(b) - 2 * common_length(a, b)


#: Letters are counted in so many cells, up to four each, one bit per letter counted.
_CELLS, _COUNTED = 64, 4


def letter_bits(text: Column) -> Column:
    """Four longs with a bit for each of the first four letters of a cell; a letter's cell is its code point modulo 64.

    Where two texts differ in a bit, one of them has a letter more in that cell.
    """
    cells = F.transform(_letters(text), lambda c: F.pmod(F.ascii(c), F.lit(_CELLS)))

    def slots(cells: Column) -> Column:
        placed = F.transform(cells, lambda c, i: F.struct(c.alias("cell"), F.size(F.filter(F.slice(cells, F.lit(1), i), lambda x: x == c)).alias("nth")))
        return F.transform(F.filter(placed, lambda p: p["nth"] < _COUNTED), lambda p: p["nth"] * _CELLS + p["cell"])

    def words(slots: Column) -> Column:
        zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
        bit = lambda s: F.call_function("shiftleft", one, F.pmod(s, F.lit(64)))
        word = lambda w: F.aggregate(F.filter(slots, lambda s: (s >= 64 * w) & (s < 64 * w + 64)), zero, lambda total, s: total.bitwiseOR(bit(s)))
        return F.struct(*[word(w).alias(f"w{w}") for w in range(_CELLS * _COUNTED // 64)])

    return let(let(cells, slots), words)


def least_distance(a: str, b: str) -> Column:
    """Letters that have at least to be deleted and inserted, from the ``letter_bits`` columns of two texts."""
    bits = [F.bit_count(F.col(f"{a}.w{w}").bitwiseXOR(F.col(f"{b}.w{w}"))) for w in range(_CELLS * _COUNTED // 64)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def names_match(a: Column, b: Column, threshold: int = NAME_SIMILARITY) -> Column:
    """Whether two names are at least ``threshold`` percent alike, whatever the order of their words."""

    def alike(left: Column, right: Column) -> Column:
        total = F.length(left) + F.length(right)
        near = indel_distance(left, right) * 100 <= (100 - threshold) * total
        return (left != "") & (right != "") & ((left == right) | near)

    found = let(sorted_tokens(a), lambda left: let(sorted_tokens(b), lambda right: alike(left, right)))
    return F.coalesce(found, F.lit(False))
