"""End-to-end jobs over landed tables, as the corpus tool runs them.

``build_corpus``: NDJSON comment dump -> raw Parquet -> detailed (S6) ->
dialogues (S7) -> cleaned (S8) -> split table (S9). Each stage is written once and the next
stage reads the written table, so no stage is recomputed and a lost
executor only re-runs the stage it was in. A run's tables become readable
together, when all are written.

``evaluate_corpus``: split table -> test rows -> user responder -> metrics.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..functions import fixed_values as V
from ..operators import corpus as C
from ..operators import infer as I
from ..operators import split as S
from ..operators.bytegrams import ByteModel
from ..operators.langid import LangModel
from ..sources import io, landed, publish


@dataclass
class CorpusPaths:
    raw: str
    detailed: str
    dialogues: str
    cleaned: str
    splits: str

    @classmethod
    def under(cls, root: str) -> "CorpusPaths":
        root = root.rstrip("/")
        return cls(f"{root}/raw", f"{root}/detailed", f"{root}/dialogues", f"{root}/cleaned", f"{root}/splits")


def build_corpus(spark: SparkSession, comment_paths, submissions: DataFrame, model: LangModel | ByteModel,
                 out: CorpusPaths, langs=V.LANGS, split: str = "ratio", key: str = "target_id",
                 parents: DataFrame | None = None, tokenizer=None, run: str = "dump",
                 detector: LangModel | ByteModel | None = None, buckets: int = landed.BUCKETS, **split_args) -> dict:
    """Run zip, generate, clean and split; publish and return the landed tables.

    ``run`` names the dump (a month). Every stage writes a folder of this
    attempt and the next one reads that folder; at the end one version is
    published (``sources.publish``) in which the run's folders replace those of
    an earlier attempt, and other months' stay. Until then readers see
    the version before, also if the job dies. ``parents`` is the comment table
    replies are matched against, by default all landed months, bucketed by id,
    so that they are not shuffled again. The splits are made over the distinct
    cleaned rows of all runs. ``split`` is "ratio" (W2, with caps), "tail" (W1)
    or "percent" (W3). ``detector`` (N2) checks replies and parents, ``model``
    where none is given. The five tables must share a parent folder; the number
    of ``buckets`` is that of its first run.
    """
    if split not in ("ratio", "tail", "percent"):
        raise ValueError("split must be ratio, tail or percent")
    tables = (out.raw, out.detailed, out.dialogues, out.cleaned, out.splits)
    roots = {publish.split_path(t)[0] for t in tables}
    if len(roots) != 1:
        raise ValueError("the tables must share a parent folder")
    root = roots.pop()
    version = publish.current(spark, root) or publish.Version(settings={"buckets": buckets})
    buckets = version.settings["buckets"]
    attempt = publish.new_folder(run)
    at = lambda table: f"{table.rstrip('/')}/{attempt}"
    for t in tables[:4]:
        version = version.with_run(publish.split_path(t)[1], run, attempt)
    version = version.replacing(publish.split_path(out.splits)[1], attempt)

    def landed_of(table: str) -> list[str]:
        return [f"{table.rstrip('/')}/{f}" for _, f in sorted(version.tables[publish.split_path(table)[1]].items())]
    # The dump is parsed once and landed in buckets: zip reads it, and every later run looks up parents in it.
    landed.write_bucketed(io.read_comments(spark, comment_paths), at(out.raw), buckets)
    comments = spark.read.schema(io.COMMENT_SCHEMA).parquet(at(out.raw))
    if parents is None:
        parents = landed.open_folders(spark, landed_of(out.raw), buckets)
    io.write_detailed(C.zip_comments(comments, model, langs), at(out.detailed), "overwrite")
    detailed = io.read_detailed(spark, at(out.detailed), langs).select(*C.DETAILED_COLUMNS)
    found = landed.parents_of(detailed, parents, V.REPLY_PREFIX)
    io.write_dialogues(C.generate_dialogues(detailed, found, submissions, detector or model, langs), at(out.dialogues), "overwrite")
    dialogues = io.read_dialogues(spark, at(out.dialogues)).select(*C.DIALOGUE_COLUMNS)
    io.write_dialogues(C.clean_dialogues(dialogues, tokenizer), at(out.cleaned), "overwrite")
    cleaned = reduce(DataFrame.unionByName, [io.read_dialogues(spark, f).select(*C.DIALOGUE_COLUMNS) for f in landed_of(out.cleaned)]).distinct()
    # All months are split anew, into a table of this attempt.
    parts = {"ratio": S.split_ratio, "tail": S.split_tail, "percent": S.split_percent}[split](cleaned, key, **split_args)
    parts.write.mode("overwrite").partitionBy("split", "lang").parquet(at(out.splits))
    publish.publish(spark, root, version)
    return {"detailed": detailed, "dialogues": dialogues, "cleaned": cleaned,
            "splits": io.read_splits(spark, out.splits)}


def evaluate_corpus(spark: SparkSession, splits_path: str, model_factory, lang: str | None = None,
                    number=V.SMALL_TRUE, metric: str = "all", strategy: str = "greedy",
                    key: str = "target_id", **options) -> DataFrame:
    """Metrics per language of a responder on the test split (one language or all)."""
    test = S.select_split(io.read_splits(spark, splits_path, lang), "test")
    return I.evaluate(test, model_factory, key, number, metric, strategy, **options)
