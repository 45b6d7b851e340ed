"""Secrets in texts, by columns and SQL functions alone.

Three patterns give the base spans.  A randomness battery adds more: runs of 16 letters and
digits or more whose encoding can be inferred (hexadecimal, also with dashes, base32 and base36
in either case, letters of both cases, base62, base64) are tested for uniform symbols
(chi-squared), for runs above and below the middle of the alphabet, and for serial
correlation.  The null hypothesis is "random"; rejecting it dismisses a run as ordinary.  Since
short runs are tested with little power and long ones with much, the share of wrong dismissals
is controlled separately per class of length (Benjamini-Hochberg), and what isn't dismissed is
reported.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.scratch import prepare, stored

KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
# A run is found at its first character, which spares trying it from every later one.
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
# Dashes that only group: in hexadecimal, and between groups of one length in one case.
DASHED = r"^(?:[0-9A-Fa-f]+(?:-[0-9A-Fa-f]+)+" + "".join(
    rf"|(?:[{case}0-9]{{{n}}}-)+[{case}0-9]{{{n}}}" for case in ("a-z", "A-Z") for n in (4, 5, 6, 8)
) + ")$"
MIN_VALUE = 6

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    16: "0123456789abcdef",
    32: _UPPER + "234567",
    36: "0123456789" + _UPPER,
    52: _UPPER + _UPPER.lower(),
    62: "0123456789" + _UPPER + _UPPER.lower(),
    64: _UPPER + _UPPER.lower() + "0123456789+/",
}
DISMISSED_WRONGLY = 0.05
# p-values are rounded up to steps of a tenth of a decade; the last holds all smaller ones.
STEPS = 400
# The first class holds runs under 24 characters, the others half octaves from there.
LENGTH_CLASSES = 9
_CHUNK = 64


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, also when it is used inside lambdas."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _sums_before(numbers: Column) -> Column:
    """For every number the sum of those before it, in about linear time."""

    def chunked(all_numbers: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(all_numbers) - 1) / _CHUNK).cast("int"))
        firsts = F.aggregate(
            chunks,
            F.array(F.lit(0).cast("long")),
            lambda acc, c: F.concat(
                acc,
                F.array(
                    F.element_at(acc, -1)
                    + _total(F.slice(all_numbers, c * _CHUNK + 1, F.lit(_CHUNK)))
                ),
            ),
        )
        return _let(
            firsts,
            lambda first: F.transform(
                all_numbers,
                lambda _, i: F.get(first, F.floor(i / _CHUNK).cast("int"))
                + _total(
                    F.slice(
                        all_numbers, F.floor(i / _CHUNK).cast("int") * _CHUNK + 1, i % _CHUNK
                    )
                ),
            ),
        )

    return _let(numbers, chunked)


def _found(text: Column, pattern: str, group: int, value: Callable[[Column], Column]) -> Column:
    """Array of (start, end, value(group)) of the pattern's matches, in code points.

    Positions follow from the lengths of the matches and of what lies between them.
    """
    empty = F.array().cast("array<struct<gap:long,own:long,value:string>>")
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
    )
    sized = _let(
        parts,
        lambda p: F.transform(
            p["hits"],
            lambda hit, i: F.struct(
                F.length(F.get(p["gaps"], i)).cast("long").alias("gap"),
                F.length(hit).cast("long").alias("own"),
                F.get(p["values"], i).alias("value"),
            ),
        ),
    )
    sized = F.when(text.rlike(pattern), sized).otherwise(empty)

    def placed(hits: Column) -> Column:
        before = _sums_before(F.transform(hits, lambda h: h["gap"] + h["own"]))
        return _let(
            before,
            lambda sums: F.transform(
                hits,
                lambda h, i: F.struct(
                    (F.get(sums, i) + h["gap"]).alias("start"),
                    (F.get(sums, i) + h["gap"] + h["own"]).alias("end"),
                    value(h["value"]).alias("value"),
                ),
            ),
        )

    # An array of no matches skips the sums, whose chunks need at least one number.
    some = _let(sized, lambda hits: F.when(F.size(hits) > 0, placed(hits)))
    return F.coalesce(some, F.slice(F.transform(F.array(F.lit(0)), lambda _: F.struct(
        F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"),
        value(F.lit("")).alias("value"))), 1, 0))


def _spans(found: Column, kind: int) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")),
    )


def _upper_tail(z: Column) -> Column:
    """P(Z >= z) of the standard normal distribution, by a rational approximation of erfc."""
    # The coefficients of the approximation (error below 1.5e-7).
    a = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    x = F.abs(z) / F.lit(2.0**0.5)
    t = 1.0 / (1.0 + 0.3275911 * x)
    series = F.lit(0.0)
    for c in reversed(a):
        series = (series + c) * t
    tail = 0.5 * series * F.exp(-x * x)
    return F.when(z >= 0, tail).otherwise(1.0 - tail)


def _bare(token: Column) -> Column:
    """The token without dashes that only group its symbols."""
    return F.when(token.rlike(DASHED), F.replace(token, F.lit("-"), F.lit(""))).otherwise(token)


def _alphabet(token: Column) -> Column:
    """Number of symbols of the smallest encoding that holds a run; null if it fits none.

    Letters of one case alone or digits alone fit none: words, names and numbers look like that.
    """
    digit, lower, upper = (token.rlike(p) for p in ("[0-9]", "[a-z]", "[A-Z]"))
    return (
        F.when(~(digit & (lower | upper)) & ~(lower & upper), F.lit(None).cast("int"))
        .when(token.rlike("^[0-9A-Fa-f]+$") & digit, 16)
        .when(token.rlike("^([a-z2-7]+|[A-Z2-7]+)$"), 32)
        .when(token.rlike("^([a-z0-9]+|[A-Z0-9]+)$"), 36)
        .when(token.rlike("^[A-Za-z]+$"), 52)
        .when(token.rlike("^[A-Za-z0-9]+$"), 62)
        .otherwise(64)
    )


def _p_value(token: Column) -> Column:
    """Probability, under randomness, of what the worst of the three tests sees (times three)."""

    def battery(bare: Column, size: Column) -> Column:
        plain = (
            F.when(size == 16, F.lower(bare))
            .when(size <= 36, F.upper(bare))
            .when(size == 64, F.translate(bare, "-_", "+/"))
            .otherwise(bare)
        )
        alphabet = F.lit(None).cast("string")
        for n, letters in ALPHABETS.items():
            alphabet = F.when(size == n, F.lit(letters)).otherwise(alphabet)
        symbols = _let(
            alphabet,
            lambda letters: F.transform(
                F.split(plain, ""), lambda c: (F.instr(letters, c) - 1).cast("double")
            ),
        )

        def tests(x: Column) -> Column:
            n = F.size(x).cast("double")
            counts = F.transform(
                F.sequence(F.lit(0), size - 1),
                lambda s: F.size(F.filter(x, lambda v: v == s.cast("double"))).cast("double"),
            )
            squares = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c * c)
            chi, df = squares * size / n - n, size - 1.0
            uneven = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
            middle = (size - 1) / 2
            above = F.size(F.filter(x, lambda v: v > middle)).cast("double")
            below = n - above
            pairs = F.zip_with(
                F.slice(x, F.lit(1), F.size(x) - 1),
                F.slice(x, F.lit(2), F.size(x) - 1),
                lambda u, v: F.struct(u.alias("u"), v.alias("v")),
            )
            runs = 1.0 + F.size(
                F.filter(pairs, lambda p: (p["u"] > middle) != (p["v"] > middle))
            ).cast("double")
            awaited = 2.0 * above * below / n + 1.0
            spread = (awaited - 1.0) * (awaited - 2.0) / (n - 1.0)
            ordered = F.when(spread > 0, F.abs(runs - awaited) / F.sqrt(spread)).otherwise(
                F.lit(40.0)
            )
            mean = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v) / n
            around = _let(
                mean,
                lambda m: F.struct(
                    F.aggregate(x, F.lit(0.0), lambda acc, v: acc + (v - m) * (v - m)).alias("all"),
                    F.aggregate(
                        pairs, F.lit(0.0), lambda acc, p: acc + (p["u"] - m) * (p["v"] - m)
                    ).alias("next"),
                ),
            )
            linked = _let(
                around,
                lambda a: F.when(
                    a["all"] > 0,
                    F.abs(a["next"] / a["all"] + 1.0 / (n - 1.0)) * F.sqrt(n - 1.0),
                ).otherwise(F.lit(40.0)),
            )
            return F.least(
                F.lit(1.0),
                3.0
                * F.least(
                    _upper_tail(uneven), 2.0 * _upper_tail(ordered), 2.0 * _upper_tail(linked)
                ),
            )

        return _let(symbols, tests)

    return _let(
        _bare(token),
        lambda bare: _let(
            _alphabet(bare), lambda size: F.when(size.isNotNull(), battery(bare, size))
        ),
    )


def _step(p: Column) -> Column:
    """Steps of a tenth of a decade that a p-value lies below 1."""
    return F.least(F.lit(STEPS), F.floor(-10.0 * F.log10(F.greatest(p, F.lit(1e-40))))).cast("int")


def _length_class(length: Column) -> Column:
    octaves = F.floor(F.log2(length / 24.0) * 2) + 1
    return F.least(F.lit(LENGTH_CLASSES - 1), F.greatest(F.lit(0), octaves)).cast("int")


def _dismissal_limits(tested: DataFrame) -> dict[int, int]:
    """Per class of length the smallest step that is dismissed (Benjamini-Hochberg on steps)."""
    counts = (
        tested.select(F.explode("_tested").alias("t"))
        .groupBy(F.col("t.class").alias("class"), F.col("t.step").alias("step"))
        .agg(F.count("*").alias("n"))
    )
    order = Window.partitionBy("class").orderBy(F.desc("step"))
    ranked = counts.withColumn("upto", F.sum("n").over(order)).withColumn(
        "all", F.sum("n").over(Window.partitionBy("class"))
    )
    p = F.pow(F.lit(10.0), -F.col("step") / 10.0)
    limits = (
        ranked.where(p <= DISMISSED_WRONGLY * F.col("upto") / F.col("all"))
        .groupBy("class")
        .agg(F.min("step").alias("limit"))
    )
    return {r["class"]: r["limit"] for r in limits.collect()}  # at most LENGTH_CLASSES rows


def find_secrets(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of every row, with ``_base`` and ``_spans``.

    Both are arrays of (start, kind, end) by start, then kind (an index into ``KINDS``); starts
    and ends count code points, ends exclusive.  ``_base`` has the matches of the three patterns,
    ``_spans`` also the runs that the battery reports, which may lie over base spans.  A null
    text counts as empty.  Texts are read once: spans and tests are stored, the counts of tests
    per class of length and step decide what is dismissed, and that is at most
    ``LENGTH_CLASSES`` numbers.  Copies are tested like any other row.
    """
    prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    whole = lambda value: value
    assigned = F.filter(
        _found(text, ASSIGN, 1, whole), lambda s: F.length(s["value"]) >= MIN_VALUE
    )
    base = F.array_sort(
        F.concat(
            _spans(assigned, 0),
            _spans(_found(text, ACCESS, 0, whole), 1),
            _spans(_found(text, HEX, 0, whole), 2),
        )
    )
    runs = F.transform(
        _found(text, RUN, 0, _p_value),
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            _length_class((s["end"] - s["start"]).cast("double")).alias("class"),
            _step(s["value"]).alias("step"),
        ),
    )
    tested = docs.select(
        *[F.col(c) for c in carry],
        base.alias("_base"),
        F.filter(runs, lambda r: r["step"].isNotNull()).alias("_tested"),
    )
    tested = stored(tested, "secrets")
    limits = _dismissal_limits(tested)

    def ordinary(run: Column) -> Column:
        cases = [(run["class"] == c) & (run["step"] >= limit) for c, limit in limits.items()]
        out = F.lit(False)
        for case in cases:
            out = out | case
        return out

    added = _spans(F.filter("_tested", lambda r: ~ordinary(r)), 3)
    return tested.select(
        *[F.col(c) for c in carry],
        "_base",
        F.array_sort(F.concat(F.col("_base"), added)).alias("_spans"),
    )


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def number_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """The text with every maximal stretch of spans replaced by ``mark``.

    A span that begins inside an earlier one only lengthens the stretch.
    """

    def joined(sorted_spans: Column) -> Column:
        # Kept pieces lie between the furthest end so far and the next start beyond it.
        start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
        return F.aggregate(
            sorted_spans,
            start,
            lambda acc, s: F.struct(
                F.greatest(acc["at"], s["end"]).alias("at"),
                F.when(
                    (s["start"] >= acc["at"]) & ((s["start"] > acc["at"]) | (acc["at"] == 0)),
                    F.concat(
                        acc["out"],
                        F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                        F.lit(mark),
                    ),
                )
                .otherwise(acc["out"])
                .alias("out"),
            ),
            lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))),
        )

    return F.when(F.size(spans) > 0, joined(spans)).otherwise(text)
