import pytest

from accounthealth.llm.frames import shared_dir


@pytest.fixture(scope="session")
def llm(spark):
    """The test session with a shared folder named."""
    shared_dir(spark)
    return spark


@pytest.fixture(scope="session")
def docs_of(llm):
    """documents-like frames with an extra column whose name an operator uses."""
    def make(rows):
        return llm.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t), "x") for i, t, s in rows],
            "doc_id long, text string, lang string, source string, n_chars long, row string")

    return make
