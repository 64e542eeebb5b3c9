import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, score double, fp long, component_id long, length long, block int, known int, `rank` int"


def lorem(seed: int, n: int) -> str:
    import random

    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Documents with every edge case, and extra columns that clash with the operators' own names."""
    texts = [
        (1, lorem(1, 60)),
        (2, None),
        (3, ""),
        (4, lorem(4, 30_000)),
        (5, "Same Row twice, over and over."),
        (5, "Same Row twice, over and over."),
        (None, lorem(6, 40)),
        (7, " \t\n\r "),
        (8, "Ünïcödé ÀÉ 東京 ΑΣ İ \x85 \xa0 <|endoftext|> <|startoftext|> 🙂 \x1c x"),
        (9, lorem(1, 60)),
        (10, "x" * 30_000),
        (11, "one two"),
    ]
    return [(i, t, "en" if k % 2 else None, "s", len(t) if t else None, 0.5, 7, 8, 9, 1, 2, 3) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(1, 1, 0), (1, 1, 1), (2, None, None), (None, 1, 1), (4, 0, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
