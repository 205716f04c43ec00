"""The tagging run: taxonomy -> rule -> rules -> source -> compute -> merge -> save.

``run_model`` returns the next store as a DataFrame (and updates the stored one
when asked).  Plan shape: the level-4 rule is parsed by a
Spark expression and only its small option map reaches the driver; the
level-5 rules are a filtered taxonomy frame broadcast into the match; the
source scan reads only the rule's fields; the merge with the store is one
full outer join on ``userId``; the write touches only the store's partitions
that the new tags fall into.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.merge import merge_tags, upsert_tags
from tagloom.operators.taxonomy import children, level4_meta
from tagloom.plans.models import TagModel
from tagloom.session import materialize
from tagloom.sources.store import read_store, update_store
from tagloom.sources.widerow import Reader, read_source


@dataclass
class ModelRun:
    new: DataFrame      # (userId, tagsId) computed by the model
    merged: DataFrame   # new ⟕ stored, merged lists (users of this run only)
    store: DataFrame    # the next store (all users)
    path: str | None = None


def model_inputs(spark: SparkSession, model: TagModel, taxonomy: DataFrame, readers: dict[str, Reader] | None = None):
    meta = level4_meta(taxonomy, model.tag_id)
    rules = children(taxonomy, model.tag_id).select("id", "rule")
    source = read_source(spark, meta, readers)
    return meta, rules, source


def run_model(
    spark: SparkSession,
    model: TagModel,
    taxonomy: DataFrame,
    store: DataFrame | None = None,
    store_root: str | None = None,
    readers: dict[str, Reader] | None = None,
    write: bool = False,
    parts: int | None = None,
) -> ModelRun:
    """Run one tag model end to end.

    ``store`` is a frame, ``store_root`` a stored one.  ``write=True`` updates
    the partitions of ``store_root`` that the new tags fall into; a new store
    gets ``parts`` partitions (see ``sources.store``).
    """
    _, rules, source = model_inputs(spark, model, taxonomy, readers)
    new = model.compute(rules, source)
    return _save(spark, new, model.mode, store, store_root, write, parts)


def _save(spark, new, mode, store, store_root, write, parts) -> ModelRun:
    """Merge ``new`` into the store (a frame, or that of ``store_root``) and write it if asked.

    A written run is read back: its frames hold the stored cells, not the
    files that the write replaced.
    """
    if write:
        if not store_root or store is not None:
            raise ValueError("write=True updates the store at store_root")
        new = materialize(new.select("userId", "tagsId"))
        update_store(new, store_root, mode, parts)
        now = read_store(spark, store_root)
        return ModelRun(new=new, merged=now.join(new.select("userId"), "userId", "left_semi"), store=now, path=store_root)
    old = store if store is not None else (read_store(spark, store_root) if store_root else None)
    if old is None:
        old = spark.createDataFrame([], "userId string, tagsId string")
    return ModelRun(new=new, merged=merge_tags(new, old), store=upsert_tags(old, new, mode=mode))


def run_models(
    spark: SparkSession,
    models: list[TagModel],
    taxonomy: DataFrame,
    store: DataFrame | None = None,
    store_root: str | None = None,
    readers: dict[str, Reader] | None = None,
    write: bool = False,
    parts: int | None = None,
) -> ModelRun:
    """Several merge-mode models of one schedule slot as one job.

    Each model's new tags are computed as in ``run_model``; they are unioned
    and merged into the store by a single upsert, so the store — the largest
    input — is read, shuffled and written once per slot instead of once per
    model.  Models that read one source by one key share a scan and an
    aggregate.  The result equals running the models one after another up to
    the order of tags inside a list (same ``canonical_tags``).  Replace-mode
    models overwrite whole cells, so their order matters: run them alone.
    """
    if any(m.mode != "merge" for m in models):
        raise ValueError("run_models combines merge-mode models only; run replace-mode models with run_model")
    news = []
    for source, group in _by_source(spark, models, taxonomy, readers):
        news += _shared(source, group) if len(group) > 1 else [group[0][0].compute(group[0][1], source)]
    new = news[0].select("userId", "tagsId")
    for n in news[1:]:
        new = new.unionByName(n.select("userId", "tagsId"))
    return _save(spark, new, "merge", store, store_root, write, parts)


def _by_source(spark, models, taxonomy, readers):
    """(source, [(model, rules), ...]): models that can share one scan and one aggregate are together."""
    groups: dict[tuple, list] = {}
    for i, m in enumerate(models):
        meta = level4_meta(taxonomy, m.tag_id)
        rules = children(taxonomy, m.tag_id).select("id", "rule")
        where = (meta.inType, meta.hbaseTable, meta.family, tuple(sorted(meta.extra.items())), getattr(m, "key_field", None))
        groups.setdefault((i,) if m.per_key() is None else where, []).append((m, rules, meta))
    for group in groups.values():
        fields = list(dict.fromkeys(f for _, _, meta in group for f in meta.fields))
        meta = replace(group[0][2], selectFields=",".join(fields))
        yield read_source(spark, meta, readers), [(m, rules) for m, rules, _ in group]


def _shared(source: DataFrame, group: list) -> list[DataFrame]:
    """New tags of several models from one aggregate per key over one scan.

    Written once: the models read narrow rows, one per key.
    """
    key = group[0][0].key_field
    aggs = [agg.alias(f"__m{i}") for i, (m, _) in enumerate(group) for agg in [m.per_key()]]
    per = materialize(source.groupBy(F.col(key).cast("string").alias("userId")).agg(*aggs))
    return [
        m.compute_per_key(rules, per.select("userId", F.col(f"__m{i}").alias("__value"))) for i, (m, rules) in enumerate(group)
    ]
