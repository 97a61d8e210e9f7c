import pytest

ODD = ["", None, " \n\t", "!!!", "a", "A b", "\0 nul \0", "Ünï çödé ẞ 文字 🙂 🙂", "x" * 5000, "same text here"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of (id, text) rows, with more columns of clashing names."""
    def make(rows):
        more = ["lang", "source", "n_chars", "key", "words", "hash", "pos", "cls", "group", "size", "target", "stats",
                "score", "copy", "shuffle_key", "item", "chunk", "id", "label", "known", "several", "document", "begin", "text_key",
                "__several", "__document", "__begin", "__text_key", "__doc_key", "pairs", "codes", "blob", "rules"]
        return spark.createDataFrame(
            [(i, t, "en", "src0" if k % 3 else None, len(t or ""), *[k] * (len(more) - 3)) for k, (i, t) in enumerate(rows)],
            "doc_id long, text string, lang string, source string, n_chars long, "
            + ", ".join(f"{c} long" for c in more[3:]))
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{k % 700}" for k in range(30_000))
    rows = list(enumerate(ODD))
    return rows + [(20, long), (21, long), (9, "same text here"), (9, "same text here"), (22, "same text here"),
                   (None, "same text here"), (None, None), (23, long[:-9]), (23, "another text under a used id")]
