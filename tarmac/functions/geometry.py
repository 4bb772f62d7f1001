"""Planar geometry as column expressions over doubles, in degrees."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

_LINE = r"(?i)^\s*LINESTRING(?:\s+Z|\s+M|\s+ZM)?\s*\(([^()]*)\)\s*$"


def line_points(wkt: Column) -> Column:
    """Vertices of a WKT line as array<struct<lon,lat>>; other kinds or bad numbers give NULL."""
    body = F.nullif(F.regexp_extract(wkt, _LINE, 1), F.lit(""))

    def vertex(text: Column) -> Column:
        ordinates = F.split(F.trim(text), r"\s+")
        return F.struct(
            F.get(ordinates, F.lit(0)).try_cast("double").alias("lon"),
            F.get(ordinates, F.lit(1)).try_cast("double").alias("lat"),
        )

    def sound(points: Column) -> Column:
        broken = F.exists(points, lambda p: p["lon"].isNull() | p["lat"].isNull())
        return F.when(~broken, points)

    # the one-element array binds the parsed points to a name, so they are parsed once
    return F.get(F.transform(F.array(F.transform(F.split(body, ","), vertex)), sound), F.lit(0))


# Well-known binary of a line: byte order, type, number of vertices, then two doubles per vertex.
_HEADER, _VERTEX, _LINE_TYPE = 9, 16, "00000002"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``; the one-element array binds the value to a name, so it is made once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _turned(digits: Column, size: int, turn: Column) -> Column:
    """Hex digits of ``size`` bytes, in the opposite order if ``turn`` holds."""
    return _let(
        digits, lambda d: F.when(turn, F.concat(*[F.substr(d, F.lit(2 * i + 1), F.lit(2)) for i in reversed(range(size))])).otherwise(d)
    )


def _digits(wkb: Column, little: Column, start: Column | int, size: int) -> Column:
    """Hex digits of a number in the bytes from ``start`` (0 is the first), most significant byte first."""
    return _turned(F.hex(F.substr(wkb, F.lit(start) + 1, F.lit(size))), size, little)


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


def _double(digits: Column) -> Column:
    """IEEE 754 double of 16 hex digits; infinities and NaN give NULL."""

    def value(high: Column, exponent: Column, fraction: Column) -> Column:
        sign = F.when(F.shiftright(high, 31) == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
        normal = (fraction + 1) * F.pow(F.lit(2.0), (exponent - 1023).cast("double"))
        tiny = fraction * F.lit(2.0**-1022)
        return F.when(exponent < 2047, sign * F.when(exponent == 0, tiny).otherwise(normal))

    def parts(halves: Column) -> Column:
        exponent = F.shiftright(halves["high"], 20).bitwiseAND(F.lit(2047))
        fraction = (F.shiftleft(halves["high"].bitwiseAND(F.lit(0xFFFFF)), 32) + halves["low"]).cast("double") / F.lit(2.0**52)
        return _let(exponent, lambda e: value(halves["high"], e, fraction))

    def halves(d: Column) -> Column:
        high, low = _number(F.substr(d, F.lit(1), F.lit(8))), _number(F.substr(d, F.lit(9), F.lit(8)))
        return _let(F.struct(high.alias("high"), low.alias("low")), parts)

    return _let(digits, halves)


def wkb_points(wkb: Column) -> Column:
    """Vertices of a WKB line of either byte order; other types, lengths or numbers give NULL."""

    def read(w: Column, order: Column) -> Column:
        little = order == "01"
        count = _number(_digits(w, little, 5, 4))
        kind = order.isin("00", "01") & (_digits(w, little, 1, 4) == _LINE_TYPE)
        sound = kind & (F.octet_length(w) == count * _VERTEX + _HEADER) & (count > 0)

        def vertex(i: Column) -> Column:
            at = i * _VERTEX + _HEADER
            return F.struct(_double(_digits(w, little, at, 8)).alias("lon"), _double(_digits(w, little, at + 8, 8)).alias("lat"))

        points = F.transform(F.sequence(F.lit(0), count.cast("int") - 1), vertex)
        whole = _let(points, lambda p: F.when(~F.exists(p, lambda v: v["lon"].isNull() | v["lat"].isNull()), p))
        return F.when(sound, whole)

    return _let(wkb, lambda w: _let(F.hex(F.substr(w, F.lit(1), F.lit(1))), lambda order: read(w, order)))


def _bits(value: Column) -> Column:
    """The 16 hex digits of a finite double."""
    negative_zero = value.cast("string") == "-0.0"

    def digits(size: Column, guess: Column) -> Column:
        exponent = F.greatest(guess, F.lit(-1022.0))
        tiny = size < F.lit(2.0**-1022)
        scaled = size / F.pow(F.lit(2.0), exponent)
        fraction = ((scaled - F.when(tiny, F.lit(0.0)).otherwise(F.lit(1.0))) * F.lit(2.0**52)).cast("bigint")
        number = F.shiftleft(F.when(tiny, F.lit(0)).otherwise((exponent + 1023).cast("bigint")), 52) + fraction
        signed = F.when(value < 0, number.bitwiseOR(F.lit(-(1 << 63)))).otherwise(number)
        zero = F.when(negative_zero, F.lit(-(1 << 63))).otherwise(F.lit(0).cast("bigint"))
        return F.lpad(F.hex(F.when(size == 0, zero).otherwise(signed)), 16, "0")

    def beside_power(size: Column, guess: Column) -> Column:  # may be one off beside a power of two
        low, high = F.pow(F.lit(2.0), guess), F.pow(F.lit(2.0), guess + 1)
        return F.when(low > size, guess - 1).when(high <= size, guess + 1).otherwise(guess)

    def of(size: Column) -> Column:
        guess = _let(F.floor(F.log2(size)).cast("double"), lambda g: beside_power(size, g))
        return _let(guess, lambda g: digits(size, g))

    return _let(F.abs(value), of)


def to_wkb(points: Column, little: Column) -> Column:
    """WKB of a line, in little or big byte order."""

    def written(p: Column) -> Column:
        head = F.concat(
            F.when(little, "01").otherwise("00"), _turned(F.lit(_LINE_TYPE), 4, little),
            _turned(F.lpad(F.hex(F.size(p).cast("bigint")), 8, "0"), 4, little),
        )
        body = F.transform(p, lambda v: F.concat(_turned(_bits(v["lon"]), 8, little), _turned(_bits(v["lat"]), 8, little)))
        return F.unhex(F.concat(head, F.array_join(body, "")))

    return _let(points, written)


def is_line(points: Column) -> Column:
    """A storable line has at least two vertices."""
    return F.coalesce(F.size(points) >= 2, F.lit(False))


def segments(points: Column) -> Column:
    """Consecutive vertex pairs as array<struct<ax,ay,bx,by>>; a single vertex gives none."""
    return F.when(
        F.size(points) >= 2,
        F.transform(
            F.sequence(F.lit(1), F.size(points) - 1),
            lambda i: F.struct(
                F.get(points, i - 1)["lon"].alias("ax"),
                F.get(points, i - 1)["lat"].alias("ay"),
                F.get(points, i)["lon"].alias("bx"),
                F.get(points, i)["lat"].alias("by"),
            ),
        ),
    )


def point_distance(px: Column, py: Column, qx: Column, qy: Column) -> Column:
    dx, dy = px - qx, py - qy
    return F.sqrt(dx * dx + dy * dy)


def segment_distance(
    px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column
) -> Column:
    """Distance from a point to the closest position on a segment; zero length means its end."""
    dx, dy = bx - ax, by - ay
    squared = dx * dx + dy * dy
    along = F.try_divide((px - ax) * dx + (py - ay) * dy, squared)
    t = F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), along)), F.lit(0.0))
    return point_distance(px, py, ax + t * dx, ay + t * dy)
