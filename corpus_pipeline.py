"""The training-data pipeline: documents through five operators, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet into the shared checkpoint folder and reads them
back as the next stage's documents, so a lost executor repeats one stage at
most; a stage's working tables are deleted once its rows are written.  All stages but the last return the columns of ``documents``:

1. quality rules: documents that the base rules or the host verdicts reject go;
2. line dedup: repeated lines stay in their first document only;
3. near-dedup: one document of each near-duplicate group stays;
4. mixing: documents repeat or go until the sources reach their targets;
5. packing: token pieces with their sequences and offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import linededup, mix, neardup, packing, quality
from ledgerline.llm.common import materialize, read_docs, release, tracking

STAGES = [
    ("quality_rules", quality.stage),
    ("line_dedup", linededup.stage),
    ("near_dedup", neardup.stage),
    ("source_mix", mix.stage),
    ("packing", packing.stage),
]

# The last stage returns token ids, which SQL cannot make; the tests hold
# every stage against a plain Python version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_docs(spark, sf_dir), []
    for name, stage in STAGES:
        written: list[str] = []
        with tracking(written):
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # the stage's own tables and its input are no longer needed
        release(spark, before + written[:-1])
        before = written[-1:]
    return docs
