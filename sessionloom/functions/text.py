"""String expressions whose results follow Python's string rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionloom.functions.plan import let

#: Every character that separates words, as a regular expression class.
WS = r"[\x09-\x0d\x1c-\x20\x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WS = WS.replace("[", "[^", 1)
THINK = r"(?s)<think>(.*?)</think>"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def filled(c: Column) -> Column:
    """Not null and not only white space."""
    return F.coalesce(c.rlike(NOT_WS), F.lit(False))


def token_estimate(c: Column) -> Column:
    """Words plus a quarter of the code points, at least 1; 0 for null and empty."""
    n = F.regexp_count(c, F.lit(f"{NOT_WS}+")) + F.floor(F.length(c) / 4).cast("int")
    return F.when(F.coalesce(F.length(c), F.lit(0)) == 0, 0).otherwise(F.greatest(n, F.lit(1))).cast("bigint")


def thinking_count(c: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(c, F.lit(THINK), F.lit(1))), F.lit(0))


def thinking_first(c: Column) -> Column:
    """The text with its thoughts moved into one leading block."""
    thoughts = F.regexp_extract_all(c, F.lit(THINK), F.lit(1))
    rest = strip(F.regexp_replace(c, THINK, ""))
    block = F.concat(F.lit("<think>\n"), F.array_join(thoughts, "\n"), F.lit("\n</think>"))
    return F.when(F.size(thoughts) > 0, F.when(rest == "", block).otherwise(strip(F.concat(block, F.lit("\n"), rest)))).otherwise(rest)


def valid_json(c: Column) -> Column:
    """Whether a text is one JSON value and nothing else; null for null. The value is read inside a wrapping
    object, where what follows it makes the whole invalid and what adds keys shows. Keys may be
    repeated in it."""
    wrapped = F.from_json(F.concat(F.lit('{"v":'), c, F.lit(',"end":1}')), "map<string,string>", {"allowSingleQuotes": "false"})
    return F.when(c.isNotNull(), let(wrapped, lambda m: F.coalesce((F.size(m) == 2) & (F.try_element_at(m, F.lit("end")) == "1"), F.lit(False))))


def clamp(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def round_half_even(c: Column, digits: int) -> Column:
    """Rounds a double in [0, 1] on its exact binary value, ties to even.

    The double is taken apart into 30 and 53 binary digits, both exact, so that the
    remainder of a division of whole numbers decides. (What is below 2**-30 rounds to 0.)
    """
    one, half = F.lit(str(2**83)).cast("decimal(25,0)"), F.lit(str(2**82)).cast("decimal(25,0)")

    def number(scaled: Column) -> Column:
        high = F.floor(scaled)
        low = ((scaled - high) * F.lit(float(2**53))).cast("bigint").cast("decimal(16,0)")
        return (high.cast("decimal(10,0)") * F.lit(2**53).cast("decimal(16,0)") + low) * F.lit(10**digits).cast("decimal(4,0)")

    def whole(n: Column) -> Column:
        q = F.floor(n / one).cast("decimal(5,0)")
        # the division may have rounded up
        q = F.when(q * one > n, q - F.lit(1).cast("decimal(1,0)")).otherwise(q).cast("decimal(5,0)")
        return let(q, lambda q: let(n - q * one, lambda r: (q + F.when((r > half) | ((r == half) & (q % F.lit(2).cast("decimal(1,0)") == 1)), 1).otherwise(0)).cast("double") / F.lit(float(10**digits))))

    return let(c * F.lit(float(2**30)), lambda scaled: let(number(scaled), whole))
