import pytest

EXTRA = (
    "ids string, decoded string, stats string, key string, score string, sig string, rep string, "
    "component string, node string, shard string, hub string, words string, row string, spans string, "
    "row_id string, row_key string, row_text string, is_target string, rejected string, matches string"
)
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
N_EXTRA = EXTRA.count(",") + 1

PROSE = (
    "the quick brown fox jumps over the lazy dog while seven calm sailors watch the harbour lights and count "
    "the boats that come home before the evening rain begins to fall on the old stone bridge"
)
OTHER = (
    "der alte mann geht langsam durch den wald und sucht nach seinem hund der schon am morgen verschwunden ist "
    "weil niemand die tuer zum garten geschlossen hatte als es zu regnen begann"
)


def odd_rows():
    """Nulls in every column, empty and blank texts, copies, repeated rows, a long text, odd bytes."""
    rows = [
        (1, PROSE, "en", "a", 1),
        (2, PROSE, "en", None, None),
        (3, PROSE.upper(), "en", "a", 3),
        (3, PROSE.upper(), "en", "a", 3),
        (4, None, "en", "a", None),
        (5, "", None, "a", 0),
        (6, " \t\n\x0b\x0c\r ", "en", "a", 7),
        (7, OTHER, "de", "a", 9),
        (8, OTHER + " ende", "de", "b", 9),
        (None, OTHER, "de", "b", 9),
        (None, None, None, None, None),
        (9, "ein wort", "de", "b", 8),
        (10, "ein wort", "de", "b", 8),
        (11, "1234 5678 !!", "en", "b", 12),
        (12, "café naïve \U0001f600   中文 ퟿�\x00x", None, "b", 1),
        (13, " ".join(f"w{i % 977}x{i}" for i in range(30_000)), "en", "b", 1),
        (14, "a" * 3000 + " " + "ab" * 2000, "en", "b", 1),
        (15, "spam eggs " * 400, "en", "b", 1),
        (9_000_000_000, PROSE + " extra", "en", "b", 1),
    ]
    return [(*r, *(["x"] * N_EXTRA)) for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def larger(spark):
    return "/root/testdata/sf0.01"
