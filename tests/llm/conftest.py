import os
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_support import SCHEMA, make_documents, write_documents  # noqa: E402


@pytest.fixture(scope="session")
def documents():
    return make_documents()


@pytest.fixture(scope="session")
def docs_dir(tmp_path_factory, documents):
    return write_documents(tmp_path_factory.mktemp("docs"), documents)


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    out = write_documents(folder, [], files=1)
    pq.write_table(pa.table({"page_id": pa.array([], pa.int64()), "url": pa.array([], pa.string()),
                             "html": pa.array([], pa.string())}), folder / "pages.parquet")
    pq.write_table(pa.table({"vec_id": pa.array([], pa.int64()), "embedding": pa.array([], pa.list_(pa.float32())),
                             "label": pa.array([], pa.int32())}), folder / "embeddings.parquet")
    return out


@pytest.fixture(scope="session")
def clash_dir(tmp_path_factory, documents):
    """The documents with repeated rows and columns named like the
    operators' own."""
    names = ["size", "rank", "key", "digest", "_row", "word", "first", "tag", "host", "kept", "copies", "a.b"]
    schema = SCHEMA
    for c in names:
        schema = schema.append(pa.field(c, pa.string()))
    rows = [r | {c: "x" for c in names} for r in documents]
    return write_documents(tmp_path_factory.mktemp("clash"), rows + rows[:40], schema)
