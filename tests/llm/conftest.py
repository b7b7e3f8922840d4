import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} of the" for i in range(40_000))


def edge_rows():
    texts = [
        None, "", " \n\t ", "one", "a b", "the the the the", "%%% ### $$$", "x" * 5000, LONG,
        "Die Katze und der Hund sind nicht in dem Haus.", "Le chat et le chien sont dans la maison.",
        "mail me at jo.doe@mail.example.org or +1 (555) 010-2222", "\U0001f600 é́ ﬁ 漢字 \x1d \x85 z", "a  b\n\nc ",
    ]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("s1", None, "")[i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[8], (None, "one", None, None, None), (None, None, None, None, None), (-5, "one", "en", "s1", 3)]
    return rows


def clashing(df):
    """Columns with the names the operators use inside."""
    names = "key n fp component words spans value row copy shuffle_key score m h language t w u v d base found text_key label rate parts cdf leak_id p".split()
    return df.select("*", *[F.lit("clash").alias(c) for c in names])


@pytest.fixture(scope="session")
def edge_docs(spark):
    return clashing(spark.createDataFrame(edge_rows(), DOC)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return clashing(spark.createDataFrame([], DOC))


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(1, LONG[:200]), (2, None), (None, "w1 w2 w3 w4 w5 w6"), (3, "x y")], "item_id long, text string")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(0, 1, 0), (3, 0, 1), (3, 0, 1), (4, 1, 0), (5, 1, 1), (6, None, None), (None, 1, 1), (8, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
