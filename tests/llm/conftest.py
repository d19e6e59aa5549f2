import pytest

from strata.llm import common

TABLE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def prepared(spark):
    common.prepare(spark)


@pytest.fixture
def docs(spark):
    def make(texts, ids=None, extra=None):
        rows = [(i, t, "en", "src", None if t is None else len(t))
                for i, t in zip(ids or range(len(texts)), texts)]
        return spark.createDataFrame(rows, TABLE)
    return make


def words(n, seed=0, stock=400):
    import random
    r = random.Random(seed)
    return [f"w{r.randrange(stock)}" for _ in range(n)]
