import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, id string, hash long, node long, n_words string, root string, copies int, rate string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (id, text[, lang[, source]]) with columns whose names operators use themselves."""
    from feedloom.session import configure

    configure(spark)

    def build(rows):
        full = [(tuple(r) + (None,) * 4)[:4] + (len(r[1] or ""),) + ("x", "y", 1, 2, "z", "r", 3, "q") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
