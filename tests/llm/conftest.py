import pytest

CLASH = ["node", "key", "component", "size", "d", "t", "h", "line", "u", "v"]


@pytest.fixture(scope="session")
def make(spark):
    """Documents with columns whose names the operators use themselves."""
    def build(rows):
        full = [(*r, *[f"{c}{k}" for c in CLASH]) for k, r in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH))

    return build


def docs(texts, first=0):
    return [(first + k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
