import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"

#: Names that the operators use inside or give out; tables may have them already.
CLASHING = "ids decoded block bucket kind keys fingerprint component_id score stats length piece sequence_id offset _row _range held_out toxic quality severity url_node f b node".split()


@pytest.fixture(scope="session")
def word_path():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def byte_path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest table, and hard rows: null, empty, blank, very long, odd
    characters, repeated rows, copies, clashing columns."""
    from pyspark.sql import functions as F

    whole = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    long = "word " * 40_000 + "x" * 30_000
    hard = [
        (10_001, None), (10_002, ""), (10_003, " \t\n\x0b\x0c\r "), (10_004, long), (10_005, "the"), (10_006, "The the"),
        (10_007, "Ünïcödé ﬁ Σίσυφος ΑΣ İ \U0001f600 é \x1c x"), (10_008, "<|endoftext|> a <|startoftext|>b it's 12 3½ !!!?"),
        (10_009, "same text of a few words here"), (10_009, "same text of a few words here"), (10_010, "same text of a few words here"),
        (10_011, "͸ unassigned �"),
    ]
    rows = whole.unionByName(spark.createDataFrame(hard, "doc_id long, text string"))
    return rows.withColumns({c: F.lit("own") for c in CLASHING}).repartition(5).cache()


@pytest.fixture(scope="session")
def rows(documents):
    return [(r["doc_id"], r["text"] or "") for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.where("false")
