"""Documents with every awkward case."""

from pyspark.sql import types as T

COLUMNS = [
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()),
    ("source", T.StringType()), ("n_chars", T.LongType()),
    # Names that the operators use themselves.
    ("kept", T.StringType()), ("_h", T.LongType()), ("c0", T.LongType()), ("row", T.LongType()),
    ("_size", T.StringType()), ("_row", T.StringType()), ("component", T.LongType()),
]
SCHEMA = T.StructType([T.StructField(n, t) for n, t in COLUMNS])
EXTRA = ("x", 1, 2, 3, "y", "z", 4)

PROSE = (
    "The quiet river bends below the old mill, and boats wait there until evening. Children throw "
    "stones from the bridge while their parents talk about the harvest, the market and the weather."
)


def documents(spark, rows):
    """Rows (doc_id, text, lang, source) as documents with clashing extra columns."""
    full = [(*r, None if r[1] is None else len(r[1]), *EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


EDGES = [
    (1, PROSE, "en", "a"),
    (2, PROSE.upper(), "en", "a"),
    (3, PROSE + " And so on it went.", "en", "b"),
    (3, PROSE + " And so on it went.", "en", "b"),
    (4, None, "en", "b"),
    (5, "", None, "c"),
    (6, " \t\r\n\x0b\x0c ", "fr", None),
    (7, "word", "fr", None),
    (8, "mit license mit license apache license", None, "c"),
    (None, "Une phrase courte, sans rien de plus.", "fr", "d"),
    (None, None, None, None),
    (9, "Zeile eins.\nZeile eins.\nÄpfel und Birnen ÉTÉ été 12345 !!! $$$", "de", "d"),
    (10, "lang " * 60_000 + PROSE, "en", "a"),
    (11, "éÉ 中文 İ \U0001f600", "xx", "\U0001f600"),
    (12, PROSE, "en", "a"),
]
