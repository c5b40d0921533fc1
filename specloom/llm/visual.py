"""Visually identical text with different characters (problem 2).

Two forms of a text are made in one vectorised pass over the distinct values of each batch:

* ``visual``: what a reader can tell apart. Characters that show nothing are dropped, blanks and hyphens of any origin,
  full- or half-width, positional and styled forms become plain ones, letters of the same shape in other scripts become Latin,
  blanks at either end go, and the result is composed. Letter case, accents, superscripts, circled digits, fractions and trade marks stay.
* ``canonical``: one consistent form for comparison. The visual form in compatibility normalisation, composed, fully case-folded,
  with white space mapped to single blanks and trimmed.

The canonical form is a function of the visual one, so values that look the same share it. Every distinct value is grouped on its canonical form;
only where several values share one is the visual form made too, as the exact check that decides.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specloom.session import cut

# Code points that Unicode calls default ignorable.
_IGNORABLE = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E),
    (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A),
    (0xE0000, 0xE0FFF),
)
# Hyphens of the same shape as the ASCII one.
_HYPHENS = "‐‑˗⁃﹣－"
# Letters of other scripts with the shape of a Latin one, after the published list of confusable characters.
_LOOKALIKES = {
    "АВЕЅІЈКМНОРСТХԌԚԜҮӀ": "ABESIJKMHOPCTXGQWYl",  # Cyrillic capitals
    "аеѕіјорсухһԁԛԝүӏ": "aesijopcyxhdqwyl",  # Cyrillic small letters
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ": "ABEZHIKMNOPTYXCJ",  # Greek capitals
    "οϲϳν": "ocjv",  # Greek small letters
    "ՕՍԼ": "OUL",  # Armenian capitals
    "օսհոզցյ": "ouhnqgj",  # Armenian small letters
    "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᎩᏃ": "ABCDEGHJKLMPRSTVWYZ",  # Cherokee
    "ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ": "ABCDEFGHIJKLMNOPRSTUVWXYZ",  # Lisu
    "ⲞⲢⲤⲦⲘⲔⲎⲚⲒⲀ": "OPCTMKHNIA",  # Coptic capitals
    "ⲟⲣⲥ": "opc",  # Coptic small letters
    "ᴄᴏᴠᴡᴢꜱɡɑ": "covwzsga",  # Latin small capitals and variants
}
# Signs with the shape of an ASCII one.
_SIGNS = {"∶꞉": "::", "∕": "/", "․": ".", "ǃ": "!", "ǀ∣": "||", "‚": ","}

_DROP = dict.fromkeys(c for a, b in _IGNORABLE for c in range(a, b + 1))
_PLAIN = dict.fromkeys(map(ord, _HYPHENS), "-")
_LATIN = {ord(a): b for others, latin in (_LOOKALIKES | _SIGNS).items() for a, b in zip(others, latin, strict=True)}
# Tags of decompositions that change how a character is laid out or coded, not what is read.
_SAME_LOOK = frozenset(("<wide>", "<narrow>", "<small>", "<font>", "<isolated>", "<initial>", "<medial>", "<final>"))
# Further code points that look like their compatibility form: Latin ligatures, roman numerals, radicals.
_SAME_LOOK_RANGES = ((0xFB00, 0xFB06), (0x2160, 0x217F), (0x2F00, 0x2FD5))


def _narrow(c: str) -> str:
    """The plain form of a width, positional or styled variant, ligature, no-break or odd blank, or of another code for the same character."""
    if unicodedata.category(c) == "Zs":
        return " "
    tag, _, rest = unicodedata.decomposition(c).partition(" ")
    same_look = tag in _SAME_LOOK or any(a <= ord(c) <= b for a, b in _SAME_LOOK_RANGES) or c in "µĲĳǇǈǉǊǋǌ"
    return unicodedata.normalize("NFKC", c) if same_look and rest else c


class _Widths(dict):
    """Translation table that fills itself with the characters met."""

    def __missing__(self, code: int) -> str:
        self[code] = out = _narrow(chr(code))
        return out


_WIDTHS = _Widths()


def visual_form(text: str) -> str:
    if text.isascii():
        return text.strip()
    s = text.translate(_DROP).translate(_PLAIN).translate(_WIDTHS)
    # Marks are split off first, so that a look-alike letter under an accent is found too.
    s = unicodedata.normalize("NFD", s).translate(_LATIN)
    return unicodedata.normalize("NFC", s).strip()


def canonical_form(visual: str) -> str:
    """From the visual form."""
    s = unicodedata.normalize("NFKC", visual).casefold()
    return " ".join(unicodedata.normalize("NFKC", s).split())


_FORMS = T.StructType([T.StructField("canonical", T.StringType()), T.StructField("visual", T.StringType())])


def _per_value(text: pd.Series) -> tuple:
    """Codes into the forms of the distinct values; code -1, null, takes none."""
    codes, values = pd.factorize(text)
    return codes, pd.Series([visual_form(v) for v in values], dtype=object)


@F.pandas_udf(_FORMS)
def _forms(text: pd.Series) -> pd.DataFrame:
    codes, visual = _per_value(text)
    canonical = visual.map(canonical_form).astype(object)
    return pd.DataFrame({"canonical": canonical.reindex(codes).to_numpy(), "visual": visual.reindex(codes).to_numpy()})


@F.pandas_udf(T.StringType())
def _canonical(text: pd.Series) -> pd.Series:
    codes, visual = _per_value(text)
    return pd.Series(visual.map(canonical_form).reindex(codes).to_numpy(), dtype=object)


# A filter or field access on the result must not run the function again.
_forms = _forms.asNondeterministic()
_canonical = _canonical.asNondeterministic()

#: ASCII white space, as a Java pattern.
_ASCII_BLANKS = r"[\t\n\x0B\f\r\x1C-\x1F ]+"


def text_forms(text: Column) -> Column:
    """Struct of ``canonical`` and ``visual`` form; null for null. Empty text has empty forms."""
    return _forms(text)


def canonical_text(text: Column) -> Column:
    """The canonical form; ASCII texts, most of all, get theirs without leaving the JVM."""
    ascii_only = F.octet_length(text) == F.length(text)
    plain = F.trim(F.lower(F.regexp_replace(text, _ASCII_BLANKS, " ")))
    return F.coalesce(_canonical(F.when(~ascii_only, text)), plain)


#: Bytes of text up to which the values of classes are broadcast; beyond, they are joined by shuffle.
BROADCAST_BYTES = 32 << 20
#: Values of a class, and records of a value, that one task pairs at a time.
BLOCK_VALUES, BLOCK_RECORDS = 256, 4096


def variant_classes(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All values that look like another value of their field, and their records.

    The first table is ``field_name, canonical, visual, value, n_values, value_id`` with the number of values of the class, the second
    ``value_id, record_key``, distinct. ``records`` has ``field_name, record_key, value``. Values are made distinct before they are compared, so a
    value that fills a third of the rows is one row; records are read again for the values of classes only.
    """
    known = records.where("value IS NOT NULL AND record_key IS NOT NULL").select("field_name", "record_key", "value")
    values = known.select("field_name", "value").distinct()
    # Grouped by a hash of the canonical form; what a collision adds here, the forms themselves part again.
    values = cut(values.withColumn("form_hash", F.xxhash64(canonical_text(F.col("value")))))
    shared = values.groupBy("field_name", "form_hash").count().where("count > 1").select("field_name", "form_hash")
    candidates = values.join(shared, ["field_name", "form_hash"], "left_semi").withColumn("form", text_forms(F.col("value")))
    candidates = cut(candidates.select("field_name", "form.canonical", "form.visual", "value"))
    several = candidates.groupBy("field_name", "canonical", "visual").agg(F.count(F.lit(1)).alias("n_values")).where("n_values > 1")
    classes = cut(candidates.join(several, ["field_name", "canonical", "visual"]).withColumn("value_id", F.monotonically_increasing_id()))
    size = classes.agg(F.sum(F.octet_length("value") + 32)).first()[0] or 0
    ids = classes.select("field_name", "value", "value_id")
    found = known.join(F.broadcast(ids) if size <= BROADCAST_BYTES else ids, ["field_name", "value"])
    return classes, cut(found.select("value_id", "record_key").distinct())


def lookalike_pairs(records: DataFrame, block_values: int = BLOCK_VALUES, block_records: int = BLOCK_RECORDS) -> DataFrame:
    """``field_name, key_a, key_b`` with key_a < key_b: records whose values look the same but differ in their characters.

    Pairs of values are made first, within classes of equal forms, where every pair of values is a pair of records at
    least; records join them afterwards, so no pair is made that is not in the result. A class of more than ``block_values`` values is
    paired block by block, and of a pair of values the records of the more frequent one are split into parts of about ``block_records``.
    Null values and keys are in no pair; an empty value pairs with one of invisible characters or blanks only;
    repeated rows count once; of a key with several values each value counts, but a key never pairs with itself.
    """
    classes, keyed = variant_classes(records)
    counts = keyed.groupBy("value_id").agg(F.count(F.lit(1)).alias("n"))
    sized = cut(classes.join(counts, "value_id").select("field_name", "visual", "value_id", "n", F.ceil(F.col("n_values") / block_values).cast("int").alias("blocks")))
    sized = sized.withColumn("block", F.pmod(F.xxhash64("value_id"), F.col("blocks")).cast("int"))
    left = sized.select("field_name", "visual", F.col("value_id").alias("l"), F.col("n").alias("n_l"), F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    right = sized.select("field_name", "visual", F.col("value_id").alias("r"), F.col("n").alias("n_r"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"), F.col("block").alias("j"))
    both = left.join(right, ["field_name", "visual", "i", "j"]).where("i < j OR l < r")
    heavier = F.col("n_l") >= F.col("n_r")
    parts = F.ceil(F.greatest("n_l", "n_r") / block_records).cast("int")
    pairs = both.select("field_name", F.when(heavier, F.col("l")).otherwise(F.col("r")).alias("a"), F.when(heavier, F.col("r")).otherwise(F.col("l")).alias("b"), parts.alias("parts"))
    pairs = cut(pairs.select("field_name", "a", "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    parted = keyed.join(sized.select("value_id", F.ceil(F.col("n") / block_records).alias("parts")), "value_id")
    parted = parted.select(F.col("value_id").alias("a"), F.pmod(F.xxhash64("record_key"), F.col("parts")).cast("int").alias("part"), F.col("record_key").alias("key_1"))
    ones = pairs.join(parted, ["a", "part"])
    twos = pairs.drop("field_name").join(keyed.select(F.col("value_id").alias("b"), F.col("record_key").alias("key_2")), "b")
    met = ones.join(twos, ["a", "b", "part"]).where("key_1 <> key_2")
    return met.select("field_name", F.least("key_1", "key_2").alias("key_a"), F.greatest("key_1", "key_2").alias("key_b")).distinct()


def class_report(records: DataFrame) -> DataFrame:
    """Per form that several values share: ``field_name, canonical, visual, n_values, n_records``, the records counted once per value."""
    classes, keyed = variant_classes(records)
    counts = keyed.groupBy("value_id").agg(F.count(F.lit(1)).alias("n"))
    return classes.join(counts, "value_id").groupBy("field_name", "canonical", "visual").agg(F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_records"))
