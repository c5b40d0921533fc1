"""Quantities recorded in different units (problem 5).

Each cell's first figure or range is read from its text, its unit is looked for beside the figure, then in the
condition, then in the unit column, and the value is converted to the common unit of its kind of quantity. Where no
place names a unit, the unit is inferred: per field, a mixture over the logarithm of the values is fitted in which every
candidate unit is a copy of the field's distribution, shifted by the unit's known conversion factor. The values that other cells of the same
product and field state are further, narrow components: as often as cells of a product restate each other, a bare figure is one of them in some unit.
The posterior of the best unit is kept and cells below ``CERTAIN`` are flagged.

Reading a cell is Python (one Arrow batch at a time); counting, fitting input and matching are relational. The fit sees a
histogram per field, whose size the bins bound, never the cells.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specloom.operators.pairs import record_pairs
from specloom.session import cut

#: A posterior below this flags an inferred unit as uncertain; uncertain cells match nothing.
CERTAIN = 0.9

#: Relative and, for temperatures, absolute difference (°C) within which two values state the same quantity.
SAME_SHARE, SAME_DEGREES = 0.01, 0.6

# Dimension -> unit -> (spellings, factor, offset); value in the common unit = (x + offset) * factor.
# The common units are W, Wh, mm, kg, m3/h, Pa, A, V, s, percent and °C.
UNITS = {
    "power": {
        "W": (("W", "watt", "watts"), 1, 0),
        "kW": (("kW", "KW", "kilowatt", "kilowatts"), 1e3, 0),
        "MW": (("MW", "megawatt", "megawatts"), 1e6, 0),
        "BTU/h": (("BTU/h", "BTUH", "Btu/hr", "BTU per hour", "British thermal units per hour"), 0.29307107, 0),
        "kBTU/h": (("kBTU/h", "kBtuh", "kBtu/hr", "MBH", "thousands of BTU per hour"), 293.07107, 0),
        "ton": (("tons of refrigeration", "ton of refrigeration", "refrigeration tons", "tons", "ton", "TR", "RT"), 3516.8528, 0),
    },
    "energy": {
        "Wh": (("Wh", "watt hour", "watt hours"), 1, 0),
        "kWh": (("kWh", "KWH", "kilowatt hour", "kilowatt hours"), 1e3, 0),
        "MWh": (("MWh", "megawatt hour", "megawatt hours"), 1e6, 0),
        "kJ": (("kJ", "kilojoule", "kilojoules"), 1 / 3.6, 0),
        "MJ": (("MJ", "megajoule", "megajoules"), 1e3 / 3.6, 0),
    },
    "length": {
        "mm": (("mm", "millimeter", "millimeters", "millimetre", "millimetres"), 1, 0),
        "cm": (("cm", "centimeter", "centimeters", "centimetre", "centimetres"), 10, 0),
        "m": (("m", "meter", "meters", "metre", "metres"), 1e3, 0),
        "in": (('"', "in.", "in", "inch", "inches"), 25.4, 0),
        "ft": (("'", "ft", "ft.", "foot", "feet"), 304.8, 0),
    },
    "mass": {
        "g": (("g", "gram", "grams"), 1e-3, 0),
        "kg": (("kg", "KG", "kgs", "kilogram", "kilograms"), 1, 0),
        "t": (("t", "tonne", "tonnes", "metric tonne", "metric tonnes", "metric ton", "metric tons"), 1e3, 0),
        "lb": (("lb", "lb.", "lbs", "lbs.", "pound", "pounds"), 0.45359237, 0),
        "oz": (("oz", "ounce", "ounces"), 0.028349523125, 0),
    },
    "flow": {
        "m3/h": (("m3/h", "m3/hr", "cmh", "cubic metres per hour", "cubic meters per hour"), 1, 0),
        "m3/min": (("m3/min", "cmm", "cubic metres per minute", "cubic meters per minute"), 60, 0),
        "m3/s": (("m3/s", "cubic metres per second", "cubic meters per second"), 3600, 0),
        "L/s": (("L/s", "lps", "litres per second", "liters per second"), 3.6, 0),
        "L/min": (("L/min", "LPM", "litres per minute", "liters per minute"), 0.06, 0),
        "ft3/min": (("CFM", "ft3/min", "cubic feet per minute"), 1.69901082, 0),
        "gpm": (("US gpm", "gpm", "gal/min", "US gallons per minute", "gallons per minute"), 0.22712470704, 0),
    },
    "pressure": {
        "Pa": (("Pa", "pascal", "pascals"), 1, 0),
        "kPa": (("kPa", "KPA", "kilopascal", "kilopascals"), 1e3, 0),
        "MPa": (("MPa", "megapascal", "megapascals"), 1e6, 0),
        "mbar": (("mbar", "millibar", "millibars"), 1e2, 0),
        "bar": (("bar", "bars"), 1e5, 0),
        "psi": (("psi", "pound per square inch", "pounds per square inch"), 6894.757293168, 0),
    },
    "current": {
        "mA": (("mA", "milliampere", "milliamperes", "milliamps"), 1e-3, 0),
        "A": (("A", "amp", "amps", "ampere", "amperes"), 1, 0),
        "kA": (("kA", "kiloampere", "kiloamperes"), 1e3, 0),
    },
    "voltage": {
        "mV": (("mV", "millivolt", "millivolts"), 1e-3, 0),
        "V": (("V", "volt", "volts", "VAC", "VDC", "V AC", "V DC"), 1, 0),
        "kV": (("kV", "KV", "kilovolt", "kilovolts"), 1e3, 0),
    },
    "time": {
        "ms": (("ms", "millisecond", "milliseconds"), 1e-3, 0),
        "s": (("s", "sec", "sec.", "second", "seconds"), 1, 0),
        "min": (("min", "min.", "mins", "minute", "minutes"), 60, 0),
        "h": (("h", "hr", "hrs", "hour", "hours"), 3600, 0),
        "d": (("d", "day", "days"), 86400, 0),
    },
    "fraction": {
        "%": (("%", "pct", "percent", "per cent"), 1, 0),
        "1": (("fraction of one", "ratio"), 100, 0),
    },
    "temperature": {
        "C": (("°C", "deg C", "degC", "degree Celsius", "degrees Celsius", "Celsius"), 1, 0),
        "F": (("°F", "deg F", "degF", "degree Fahrenheit", "degrees Fahrenheit", "Fahrenheit"), 1 / 1.8, -32),
        "K": (("K", "kelvin", "kelvins"), 1, -273.15),
    },
}

# Other spellings of characters that NFKC would turn into something else.
_BEFORE_NFKC = str.maketrans({"⁰": "°", "º": "°", "˚": "°", "″": '"', "”": '"', "“": '"', "′": "'", "’": "'", "…": " to ", "−": "-", "–": "–", "—": "–", "×": "x"})
_SUPERSCRIPTS = "⁰¹²³⁴⁵⁶⁷⁸⁹⁻"


def _clean(text: str) -> str:
    text = re.sub(f"(?<=10)[{_SUPERSCRIPTS}]+", lambda m: "^" + unicodedata.normalize("NFKC", m[0]).replace("−", "-"), text)
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text.translate(_BEFORE_NFKC))).strip()


def _spelling(text: str) -> str:
    return re.escape(text).replace(r"\ ", r"\s?")


class _Spellings:
    """All spellings of one dimension as one pattern, longest first, and what they name.

    Spellings compare exactly first; without regard to case where that names one unit only.
    """

    def __init__(self, units: dict) -> None:
        self.exact, loose = {}, {}
        for unit, (names, _, _) in units.items():
            for name in names:
                self.exact[re.sub(r"\s", "", name)] = unit
                loose.setdefault(re.sub(r"\s", "", name).casefold(), set()).add(unit)
        self.loose = {k: next(iter(v)) for k, v in loose.items() if len(v) == 1}
        names = sorted((n for u in units.values() for n in u[0]), key=len, reverse=True)
        # A spelling that ends in a letter must not run on into a longer word.
        self.text = "|".join(_spelling(n) + (r"(?![A-Za-z0-9/])" if n[-1].isalnum() else "") for n in names)
        self.whole = re.compile(self.text, re.IGNORECASE)

    def unit(self, spelling: str | None) -> str | None:
        if not spelling:
            return None
        key = re.sub(r"\s", "", spelling)
        return self.exact.get(key) or self.loose.get(key.casefold())


_DIMENSIONS = {name: _Spellings(units) for name, units in UNITS.items()}

# A figure: digits grouped by single blanks before exactly three digits, commas and dots, then a power of ten or a vulgar fraction.
_DIGITS = r"(?:\d{1,3}(?: \d{3})+(?!\d)|\d+)(?:[.,]\d+)*"
_FIGURE = rf"(?:{_DIGITS})(?:\s?x\s?10\s?\^\s?[-+]?\d+|(?:[eE][-+]?\d+)(?![A-Za-z])|\s\d+/\d+|/\d+(?=\s?(?:\"|in)))?"
# What comes before the unit that a condition states for the figures.
_STATES = r"(?:\b(?:in|as|gives?)\s+|\b(?:units?|Einheit(?:en)?)(?:\s+(?:is|are|ist))?\s*[:=]?\s*|单位\s*[:：=]?\s*)"
_STATED = re.compile(_STATES + "$", re.IGNORECASE)
_SCALE = re.compile(r"(?:^|[;,]\s*)x\s?(10+)\b|\bin (thousand|million|hundred)s?\b(?! of BTU)", re.IGNORECASE)
_RATIO = re.compile(r"fraction of one|\bratio\b|\b1 = full\b", re.IGNORECASE)
_SCALES = {"hundred": 1e2, "thousand": 1e3, "million": 1e6}


def _patterns(dimension: str) -> re.Pattern:
    u = _DIMENSIONS[dimension].text
    return re.compile(
        rf"(?P<sign>(?<![\w.,)])[-+])?(?P<first>{_FIGURE})\s?(?P<u1>{u})?"
        rf"(?:\s?(?:to|–|-|\.\.\.?)\s?(?P<sign2>[-+])?(?P<second>{_FIGURE})\s?(?P<u2>{u})?)?",
        re.IGNORECASE,
    )


_CELL = {name: _patterns(name) for name in UNITS}
_FEET = re.compile(rf"(?P<ft>{_DIGITS})\s?(?:'|ft\.?)\s?(?P<in>{_DIGITS}(?:\s\d+/\d+)?)\s?(?:\"|in\b)", re.IGNORECASE)


def _number(text: str) -> float:
    """Value of a figure: with comma and dot the last one is decimal; else a comma or blank before exactly three digits groups, and a dot is decimal."""
    text, power = text.strip(), 1.0
    if m := re.search(r"\s?x\s?10\s?\^\s?([-+]?\d+)$", text):
        text, power = text[: m.start()], 10.0 ** int(m[1])
    elif m := re.search(r"[eE]([-+]?\d+)$", text):
        text, power = text[: m.start()], 10.0 ** int(m[1])
    if m := re.search(r"(?:^|\s)(\d+)/(\d+)$", text):
        whole = text[: m.start()].strip()
        return (_number(whole) if whole else 0.0) + (int(m[1]) / int(m[2]) if int(m[2]) else 0.0)
    text = re.sub(r" (?=\d{3}(?!\d))", "", text)
    if "," in text and "." in text:
        last = max(text.rfind(","), text.rfind("."))
        text = re.sub(r"[.,]", "", text[:last]) + "." + text[last + 1 :]
    elif "," in text:
        text = re.sub(r",(?=\d{3}(?!\d))", "", text).replace(",", ".")
    if text.count(".") > 1:
        text = text.replace(".", "")
    return float(text) * power


def _condition_unit(condition: str, dimension: str) -> tuple[str | None, float]:
    """The unit and the scale that a condition states for the figures."""
    names, unit = _DIMENSIONS[dimension], None
    for m in names.whole.finditer(condition):
        if _STATED.search(condition[: m.start()]):
            unit = names.unit(m[0]) or unit
    if dimension == "fraction" and _RATIO.search(condition):
        unit = "1"
    scale = 1.0
    for m in _SCALE.finditer(condition):
        scale *= float(m[1]) if m[1] else _SCALES[m[2].lower()]
    return unit, scale


def read_cell(dimension: str | None, expect: str | None, unit: str | None, condition: str | None) -> tuple:
    """``(low, high, unit, unit_source)`` of a cell as stated, not converted; all null without a figure, unit null where no place names one."""
    if dimension not in UNITS or not expect:
        return None, None, None, None
    text, names = _clean(expect), _DIMENSIONS[dimension]
    said, scale = _condition_unit(_clean(condition), dimension) if condition else (None, 1.0)
    cell = _CELL[dimension].search(text)
    if not cell:
        return None, None, None, None
    if dimension == "length" and (feet := _FEET.search(text)) and feet.start() <= cell.start():
        inches = (_number(feet["ft"]) * 12 + _number(feet["in"])) * scale
        return inches, inches, "in", "figure"
    low = _number(cell["first"]) * (-1 if cell["sign"] == "-" else 1)
    high = _number(cell["second"]) * (-1 if cell["sign2"] == "-" else 1) if cell["second"] else low
    first, second = names.unit(cell["u1"]), names.unit(cell["u2"])
    if first or second:
        if first and second and first != second:
            # A range with a unit of its own at either end.
            (_, f1, o1), (_, f2, o2) = UNITS[dimension][first], UNITS[dimension][second]
            high = (high + o2) * f2 / f1 - o1
        chosen, source = first or second, "figure"
    elif said:
        chosen, source = said, "condition"
    else:
        chosen, source = names.unit(re.sub(r"\s*\[.*", "", _clean(unit or ""))), "column"
    low, high = sorted((low * scale, high * scale))
    return low, high, chosen, source if chosen else None


def to_common(dimension: str, unit: str, value):
    """A value or array in the common unit of its dimension."""
    _, factor, offset = UNITS[dimension][unit]
    return (value + offset) * factor


_READ = T.StructType([T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()), T.StructField("unit", T.StringType()), T.StructField("unit_source", T.StringType())])


@F.pandas_udf(_READ)
def _read(dimension: pd.Series, expect: pd.Series, unit: pd.Series, condition: pd.Series) -> pd.DataFrame:
    seen: dict[tuple, tuple] = {}
    out = []
    for cell in zip(*(s.astype(object).where(s.notna(), None) for s in (dimension, expect, unit, condition))):
        if cell not in seen:
            low, high, name, source = read_cell(*cell)
            if name is not None:
                low, high = to_common(cell[0], name, low), to_common(cell[0], name, high)
            seen[cell] = (low, high, name, source)
        out.append(seen[cell])
    return pd.DataFrame(out, columns=["low", "high", "unit", "unit_source"]).astype({"low": float, "high": float})


# A filter on the result must not run the function a second time below the projection.
_read = _read.asNondeterministic()


@F.pandas_udf(T.StringType())
def _dimension_of(unit: pd.Series, said: pd.Series, beside: pd.Series) -> pd.Series:
    """The dimension that the first readable of three spellings names; spellings of several dimensions name none."""

    def one(*spellings: str | None) -> str | None:
        for s in spellings:
            if s:
                s = re.sub(r"\s*\[.*", "", _clean(s))
                found = [d for d, names in _DIMENSIONS.items() if names.unit(s)]
                if len(found) == 1:
                    return found[0]
        return None

    return pd.Series([one(*x) for x in zip(unit, said, beside)], dtype=object)


def field_dimensions(cells: DataFrame) -> DataFrame:
    """``field, dimension``: the dimension that most of a field's cells name. Fields whose cells name none are left out.

    Cells are first counted per field and spelling, so a frequent field costs one row per spelling.
    """
    said = F.regexp_extract(F.coalesce("condition", F.lit("")), "(?i)" + _STATES + r"([^0-9,;()]+?)\s*(?:[,;(]|\.?$)", 1)
    beside = F.regexp_extract(F.coalesce("expect", F.lit("")), r"^[^0-9]*[0-9][0-9.,  \s]*([^0-9.,\s(][^0-9(]*?)\s*$", 1)
    spelt = cells.where("field IS NOT NULL").groupBy("field", "unit", said.alias("said"), beside.alias("beside")).count()
    votes = spelt.withColumn("dimension", _dimension_of("unit", "said", "beside")).where("dimension IS NOT NULL")
    counted = votes.groupBy("field", "dimension").agg(F.sum("count").alias("n"))
    return counted.groupBy("field").agg(F.max_by("dimension", F.struct("n", "dimension")).alias("dimension"))


_dimension_of = _dimension_of.asNondeterministic()

#: Bins of the fit: hundredths of a power of ten, or half degrees.
_BIN = 0.01
_DEGREE_BIN = 0.5
_COMPONENTS = 3
_ROUNDS = 60


def _axis(dimension: str, value: np.ndarray) -> np.ndarray:
    return value if dimension == "temperature" else np.log10(value)


_MASSES = "field string, bin long, unit string, prior double, mass double"


def unit_masses(histogram: pd.DataFrame) -> pd.DataFrame:
    """How likely one field's figures without a unit have each unit, by bin: ``field, bin, unit, prior, mass``.

    ``histogram`` has ``field, dimension, known, bin, n``: bins of values in the common unit where ``known``, of bare figures otherwise.
    The density of the common values is a Gaussian mixture; a bare figure comes from a unit (with a weight to be fitted) and
    then from that density at the figure converted by the unit. Known and bare figures are fitted together by expectation
    maximisation. ``prior`` is the unit's weight, ``mass`` the probability of the unit and of a value that agrees with the converted figure. A field without known values
    gives no rows: nothing says which unit its figures have.
    """
    dimension, field = histogram["dimension"].iloc[0], histogram["field"].iloc[0]
    width = _DEGREE_BIN if dimension == "temperature" else _BIN
    known, bare = histogram[histogram["known"]], histogram[~histogram["known"]]
    if known.empty or bare.empty:
        return pd.DataFrame({"field": [], "bin": [], "unit": [], "prior": [], "mass": []})
    x, n = known["bin"].to_numpy() * width, known["n"].to_numpy(float)
    y, m = bare["bin"].to_numpy() * width, bare["n"].to_numpy(float)
    units = list(UNITS[dimension])
    raw = y if dimension == "temperature" else 10.0**y
    converted = np.stack([np.asarray(to_common(dimension, u, raw), float) for u in units])
    ok = np.ones_like(converted, bool) if dimension == "temperature" else converted > 0
    z = _axis(dimension, np.where(ok, converted, 1.0))
    # The bare axis is stretched against the common one where a unit's step is another (degrees).
    stretch = np.array([abs(UNITS[dimension][u][1]) if dimension == "temperature" else 1.0 for u in units])

    order = np.argsort(x)
    share = (np.cumsum(n[order]) - n[order] / 2) / n.sum()
    mu = np.interp((np.arange(_COMPONENTS) + 0.5) / _COMPONENTS, share, x[order])
    spread = max(np.sqrt(np.average((x - np.average(x, weights=n)) ** 2, weights=n)), 5 * width)
    sd, weight = np.full(_COMPONENTS, spread), np.full(_COMPONENTS, 1 / _COMPONENTS)
    prior = np.full(len(units), 1 / len(units))

    def density(v: np.ndarray) -> np.ndarray:
        return weight * np.exp(-0.5 * ((v[..., None] - mu) / sd) ** 2) / (sd * np.sqrt(2 * np.pi)) + 1e-300

    for _ in range(_ROUNDS):
        a = density(x)
        a = a / a.sum(-1, keepdims=True) * n[:, None]
        b = density(z) * (prior * stretch)[:, None, None] * ok[..., None]
        b = b / b.sum((0, 2), keepdims=True) * m[None, :, None]
        total = a.sum(0) + b.sum((0, 1))
        mu = ((a * x[:, None]).sum(0) + (b * z[..., None]).sum((0, 1))) / total
        var = ((a * (x[:, None] - mu) ** 2).sum(0) + (b * (z[..., None] - mu) ** 2).sum((0, 1))) / total
        sd, weight = np.sqrt(np.maximum(var, (2 * width) ** 2)), total / total.sum()
        prior = (b.sum((1, 2)) + 0.5) / (m.sum() + 0.5 * len(units))
    same = 2 * (SAME_DEGREES if dimension == "temperature" else np.log10(1 + SAME_SHARE))
    mass = np.minimum(density(z).sum(-1) * same, 1.0) * (prior * stretch)[:, None] * ok
    n_bins = len(bare)
    return pd.DataFrame({
        "field": field, "bin": np.tile(bare["bin"].to_numpy(), len(units)), "unit": np.repeat(units, n_bins), "prior": np.repeat(prior * stretch, n_bins) * ok.ravel(), "mass": mass.ravel(),
    })


def _converted(column: str):
    """A column in the common unit of ``dimension``, from ``unit``; as it is where the unit is null."""
    factor, offset = (
        F.element_at(F.create_map(*[F.lit(v) for d, us in UNITS.items() for u, spec in us.items() for v in (f"{d}:{u}", float(spec[i]))]), F.concat_ws(":", "dimension", "unit"))
        for i in (1, 2)
    )
    return F.when(F.col("unit").isNotNull(), (F.col(column) + offset) * factor).otherwise(F.col(column))


def _value_bin(column: str):
    """Bin of a value as wide as the difference within which two values state the same; sign and zero apart."""
    size = F.round(F.log10(F.abs(column)) / float(np.log10(1 + SAME_SHARE)))
    return F.when(F.col("dimension") == "temperature", F.round(F.col(column) / SAME_DEGREES)).when(F.col(column) > 0, size).cast("long")


def infer_units(read: DataFrame) -> DataFrame:
    """Cells without a unit, with the most likely one: ``map_id, product, field, dimension, low, high, unit, posterior``, values as stated and null unit where nothing says.

    ``read`` has ``map_id, product, field, dimension, low, high, unit, bin``, with values in the common unit where a unit is known. A figure has each unit with the mass of the field's mixture; and, with the share
    of a field's cells that restate another cell of their product, with the prior of a unit that turns it into one of the product's known values.
    """
    bare_fields = read.where("unit IS NULL").select("field").distinct()
    histogram = (
        read.where("bin IS NOT NULL").join(bare_fields, "field", "left_semi")
        .groupBy("field", "dimension", F.col("unit").isNotNull().alias("known"), "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    masses = cut(histogram.groupBy("field").applyInPandas(unit_masses, _MASSES))
    known = read.where("unit IS NOT NULL AND product IS NOT NULL").join(bare_fields, "field", "left_semi")
    values = cut(known.withColumn("value_bin", _value_bin("low")).where("value_bin IS NOT NULL").groupBy("product", "field", "value_bin").agg(F.count(F.lit(1)).alias("n")))
    of_product = values.groupBy("product", "field").agg(F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_cells"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("n_restated"))
    # With two imagined cells, one of which restates, so that a field of few cells is not certain of either.
    restated = of_product.where("n_cells > 1").groupBy("field").agg(((F.sum("n_restated") + 1) / (F.sum("n_cells") + 2)).alias("restated"))
    bare = cut(read.where("unit IS NULL").drop("unit").withColumn("cell", F.monotonically_increasing_id()))
    tried = bare.select("cell", "product", "field", "dimension", "low", "bin").join(masses, ["field", "bin"]).where("prior > 0")
    tried = tried.withColumn("common", _converted("low")).withColumn("value_bin", _value_bin("common"))
    near = tried.select("cell", "unit", "product", "field", F.explode(F.array(F.col("value_bin") - 1, F.col("value_bin"), F.col("value_bin") + 1)).alias("value_bin")).where("value_bin IS NOT NULL")
    hits = near.join(values.select("product", "field", "value_bin"), ["product", "field", "value_bin"]).groupBy("cell", "unit").agg(F.lit(True).alias("hit"))
    told = tried.join(hits, ["cell", "unit"], "left").join(of_product.select("product", "field", "n_values"), ["product", "field"], "left").join(restated, "field", "left")
    share = F.when(F.col("n_values") > 0, F.coalesce("restated", F.lit(0.5))).otherwise(0.0)
    weight = (1 - share) * F.col("mass") + F.when(F.col("hit"), share * F.col("prior") / F.col("n_values")).otherwise(0.0)
    best = told.withColumn("weight", weight).groupBy("cell").agg(F.max(F.struct("weight", "unit")).alias("best"), F.sum("weight").alias("total"))
    best = best.select("cell", "best.unit", F.when(F.col("total") > 0, F.col("best.weight") / F.col("total")).otherwise(0.0).alias("posterior"))
    return bare.join(best, "cell", "left").select("map_id", "product", "field", "dimension", "low", "high", "unit", "posterior")


def quantities(cells: DataFrame) -> DataFrame:
    """Measured quantities in common units: ``map_id, product, field, dimension, low, high, unit, unit_source, posterior, uncertain``.

    ``cells`` has ``map_id, product, field, unit, condition, expect``; repeated rows count once. ``low`` and ``high`` are in the
    common unit of the dimension (equal for a single figure), ``unit`` is the one the cell was stated in, ``unit_source`` is
    ``figure``, ``condition``, ``column`` or ``inferred`` (then with the posterior). Cells without a figure, of fields that measure nothing,
    or with a null field give no row. A cell whose unit can be neither read nor inferred is kept with null unit and
    values as stated, flagged uncertain.
    """
    cells = cells.select("map_id", "product", "field", "unit", "condition", "expect").distinct()
    dimensions = cut(field_dimensions(cells))
    # Fields are a vocabulary, but only a checked number of them is broadcast.
    known_fields = F.broadcast(dimensions) if dimensions.count() <= 100_000 else dimensions
    read = cells.join(known_fields, "field").withColumn("q", _read("dimension", "expect", "unit", "condition"))
    read = read.where("q.low IS NOT NULL AND NOT isnan(q.low)").select("map_id", "product", "field", "dimension", "q.*")
    positive = F.col("low") > 0
    axis = F.when(F.col("dimension") == "temperature", F.round(F.col("low") / _DEGREE_BIN)).when(positive, F.round(F.log10("low") / _BIN))
    read = cut(read.withColumn("bin", axis.cast("long")))
    stated = read.where("unit IS NOT NULL").select(
        "map_id", "product", "field", "dimension", "low", "high", "unit", "unit_source", F.lit(None).cast("double").alias("posterior"), F.lit(False).alias("uncertain")
    )
    if read.where("unit IS NULL").isEmpty():
        return stated
    inferred = infer_units(read.drop("unit_source")).select(
        "map_id", "product", "field", "dimension", _converted("low").alias("low"), _converted("high").alias("high"), "unit", F.when(F.col("unit").isNotNull(), "inferred").alias("unit_source"),
        "posterior", (F.coalesce("posterior", F.lit(0.0)) < CERTAIN).alias("uncertain"),
    )
    return stated.unionByName(inferred)


def quantity_classes(q: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells of one product and field with the same value, and the classes of nearly the same value.

    Members are ``class_id, n, map_id``, a class being one product, field and value in the common unit and its id the smallest map_id of it and n its cells; links are ``a, b, n_a, n_b``
    with a < b, classes whose values agree at both ends. However often a value is stated, it is compared once. Values are binned by the allowed
    difference, so that agreeing ones lie in the same or the next bin; a class meets only those, and the exact condition follows. Null products
    and uncertain cells are in no class.
    """
    usable = q.where("NOT uncertain AND product IS NOT NULL AND field IS NOT NULL AND map_id IS NOT NULL")
    value = ["product", "field", "dimension", "low", "high"]
    cells = cut(usable.select("map_id", *value).distinct())
    classes = cut(cells.groupBy(*value).agg(F.min("map_id").alias("class_id"), F.count(F.lit(1)).alias("n")))
    members = cells.join(classes, value).select("class_id", "n", "map_id")
    is_t = F.col("dimension") == "temperature"
    step = float(-np.log(1 - SAME_SHARE) * 1.000001)
    bin_ = (
        F.when(is_t, F.floor(F.col("low") / F.lit(SAME_DEGREES * 1.000001)))
        .when(F.col("low") == 0, F.lit(0))
        .otherwise(F.floor(F.log(F.abs("low")) / F.lit(step)))
    )
    side = F.when(is_t, F.lit(0)).otherwise(F.signum("low").cast("int"))
    binned = classes.select("class_id", "n", *value, side.alias("side"), bin_.cast("long").alias("bin"))
    left = binned.select("product", "field", "dimension", "side", F.struct("class_id", "n").alias("l"), F.col("low").alias("l_low"), F.col("high").alias("l_high"), F.col("bin").alias("at"))
    right = binned.select(
        "product", "field", "dimension", "side", F.struct("class_id", "n").alias("r"), F.col("low").alias("r_low"), F.col("high").alias("r_high"), F.col("bin").alias("r_bin"),
        F.explode(F.array(F.col("bin"), F.col("bin") - 1)).alias("at"),
    )

    def close(a: str, b: str):
        limit = F.when(is_t, F.lit(SAME_DEGREES)).otherwise(F.greatest(F.abs(a), F.abs(b)) * SAME_SHARE)
        return F.abs(F.col(a) - F.col(b)) <= limit + F.greatest(F.abs(a), F.abs(b)) * 1e-9 + 1e-12

    once = (F.col("at") != F.col("r_bin")) | (F.col("l.class_id") < F.col("r.class_id"))
    other = F.col("l.class_id") != F.col("r.class_id")
    met = left.join(right, ["product", "field", "dimension", "side", "at"]).where(once & other & close("l_low", "r_low") & close("l_high", "r_high"))
    first, second = F.least("l", "r"), F.greatest("l", "r")
    # Two bins of the right side lie apart, so a pair of classes is met once.
    return members, met.select(first["class_id"].alias("a"), second["class_id"].alias("b"), first["n"].alias("n_a"), second["n"].alias("n_b"))


def same_quantities(q: DataFrame) -> DataFrame:
    """Pairs ``map_id_a < map_id_b`` of one product and field whose values in the common unit agree at both ends: ``quantity_classes``, expanded."""
    members, links = quantity_classes(q)
    members = cut(members)
    itself = members.where("class_id = map_id AND n > 1").select(F.col("class_id").alias("a"), F.col("class_id").alias("b"), F.col("n").alias("n_a"), F.col("n").alias("n_b"))
    pairs = record_pairs(links.unionByName(itself), members.withColumnRenamed("map_id", "record_key"))
    # A class with itself gives each pair in both orders.
    return pairs.where("key_1 <> key_2").select(F.least("key_1", "key_2").alias("map_id_a"), F.greatest("key_1", "key_2").alias("map_id_b")).distinct()
