"""Command-line runner: one tag model as one Spark job (what a scheduler submits).

Example::

    spark-submit tagloom/plans/jobs.py --model recency --tag-id 23 \\
        --taxonomy-format jdbc --taxonomy-option url=jdbc:mysql://db/tags \\
        --taxonomy-option dbtable=tbl_basic_tag --taxonomy-option user=... \\
        --store-root s3a://bucket/tag-store --as-of 2024-01-31

The level-4 rule of ``--tag-id`` names the source (``inType`` +
``hbaseTable``/``path``); ``--register name=path`` exposes parquet folders
as the tables the rules name.  The store at
``--store-root`` is updated.  Connection settings come only from the options.

Ingest of a ``\\x01`` extract (one of ``logs users orders goods``)::

    spark-submit tagloom/plans/jobs.py ingest --kind logs --src s3a://in/logs/ --dest s3a://out/logs-sorted/
    spark-submit tagloom/plans/jobs.py ingest --kind logs --src s3a://in/logs/ --dest s3a://out/logs/ --stream

The batch form publishes the rows sorted by key; ``--stream`` runs the
incremental form (only files not seen before, ``availableNow``); what was seen
is kept in ``--checkpoint``, by default a folder inside ``--dest``, and so is
known to the next application.

A schedule slot — several merge-mode models, one store upsert::

    spark-submit tagloom/plans/jobs.py slot --model recency:23:as_of=2024-01-31 \
        --model exact:30:key_field=memberId,value_field=orderstatus,on_unmatched=drop \
        --taxonomy-format parquet --taxonomy-option path=... --store-root ...
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a script (spark-submit path/to/jobs.py): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tagloom.plans.models import ActivityModel, AgeRangeModel, ExactMatchModel, RecencyRangeModel, TagModel
from tagloom.plans.runner import run_model
from tagloom.session import get_session
from tagloom.sources.taxonomy import read_taxonomy


def build_model(a: argparse.Namespace) -> TagModel:
    if a.model == "exact":
        return ExactMatchModel(a.tag_id, mode=a.mode, key_field=a.key_field or "id",
                               value_field=a.value_field or "value", on_unmatched=a.on_unmatched)
    if a.model == "recency":
        return RecencyRangeModel(a.tag_id, mode=a.mode, key_field=a.key_field or "memberId",
                                 time_field=a.time_field or "finishTime", shift_days=a.shift_days, as_of=a.as_of)
    if a.model == "age":
        return AgeRangeModel(a.tag_id, mode=a.mode, key_field=a.key_field or "id",
                             birthday_field=a.value_field or "birthday", as_of=a.as_of)
    if a.model == "activity":
        return ActivityModel(a.tag_id, mode=a.mode, key_field=a.key_field or "global_user_id",
                             time_field=a.time_field or "log_time", action_field=a.value_field or "loc_url",
                             as_of=a.as_of, k=a.k)
    raise ValueError(a.model)


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tagloom-job")
    p.add_argument("--model", required=True, choices=["exact", "recency", "age", "activity"])
    p.add_argument("--tag-id", type=int, required=True)
    p.add_argument("--mode", default="merge", choices=["merge", "replace"])
    p.add_argument("--key-field")
    p.add_argument("--value-field")
    p.add_argument("--time-field")
    p.add_argument("--on-unmatched", default="error", choices=["error", "null", "drop"])
    p.add_argument("--shift-days", type=int, default=30)
    p.add_argument("--k", type=int, default=4)
    p.add_argument("--as-of")
    p.add_argument("--taxonomy-format", default="parquet")
    p.add_argument("--taxonomy-option", action="append", default=[], help="k=v, repeatable")
    p.add_argument("--register", action="append", default=[], help="table=parquet_path, repeatable")
    p.add_argument("--store-root", required=True)
    p.add_argument("--store-parts", type=int, help="hash partitions of a new store (default: by its size)")
    return p.parse_args(argv)


def ingest_main(argv: list[str]) -> str:
    from tagloom.schemas import EXTRACT_COLUMNS
    from tagloom.sources.extracts import ingest
    from tagloom.streaming import start_extract_stream

    p = argparse.ArgumentParser(prog="tagloom-ingest")
    p.add_argument("--kind", required=True, choices=sorted(EXTRACT_COLUMNS))
    p.add_argument("--src", required=True)
    p.add_argument("--dest", required=True)
    p.add_argument("--partitions", type=int)
    p.add_argument("--stream", action="store_true")
    p.add_argument("--checkpoint", help="stream checkpoint (default: _checkpoint inside --dest)")
    a = p.parse_args(argv)
    spark = get_session(app=f"tagloom-ingest-{a.kind}")
    if a.stream:
        start_extract_stream(spark, a.src, a.kind, a.dest, checkpoint=a.checkpoint).awaitTermination()
    else:
        ingest(spark, a.src, a.kind, a.dest, partitions=a.partitions)
    print(a.dest)
    return a.dest


_KINDS = {"exact": ExactMatchModel, "recency": RecencyRangeModel, "age": AgeRangeModel, "activity": ActivityModel}
_INT_FIELDS = {"shift_days", "lookback_days", "k", "seed"}


def parse_model_spec(spec: str) -> TagModel:
    """``kind:tag_id[:field=value,field=value]`` -> a model (fields as in ``plans.models``)."""
    parts = spec.split(":", 2)
    if len(parts) < 2 or parts[0] not in _KINDS:
        raise ValueError(f"model spec '{spec}': expected kind:tag_id[:field=value,...] with kind in {sorted(_KINDS)}")
    fields = {}
    if len(parts) == 3 and parts[2]:
        for kv in parts[2].split(","):
            k, v = kv.split("=", 1)
            fields[k] = int(v) if k in _INT_FIELDS else v
    return _KINDS[parts[0]](int(parts[1]), **fields)


def slot_main(argv: list[str]) -> str:
    from tagloom.plans.runner import run_models

    p = argparse.ArgumentParser(prog="tagloom-slot")
    p.add_argument("--model", action="append", required=True, help="kind:tag_id[:field=value,...], repeatable")
    p.add_argument("--taxonomy-format", default="parquet")
    p.add_argument("--taxonomy-option", action="append", default=[])
    p.add_argument("--register", action="append", default=[])
    p.add_argument("--store-root", required=True)
    p.add_argument("--store-parts", type=int)
    a = p.parse_args(argv)
    spark = get_session(app="tagloom-slot")
    for reg in a.register:
        name, path = reg.split("=", 1)
        spark.read.parquet(path).createOrReplaceTempView(name)
    taxonomy = read_taxonomy(spark, a.taxonomy_format, **dict(kv.split("=", 1) for kv in a.taxonomy_option))
    models = [parse_model_spec(m) for m in a.model]
    run = run_models(spark, models, taxonomy, store_root=a.store_root, write=True, parts=a.store_parts)
    print(run.path)
    return run.path


def main(argv: list[str] | None = None) -> str:
    argv = sys.argv[1:] if argv is None else list(argv)
    if argv and argv[0] == "ingest":
        return ingest_main(argv[1:])
    if argv and argv[0] == "slot":
        return slot_main(argv[1:])
    if argv and argv[0] == "model":
        argv = argv[1:]
    a = parse_args(argv)
    spark = get_session(app=f"tagloom-{a.model}-{a.tag_id}")
    for reg in a.register:
        name, path = reg.split("=", 1)
        spark.read.parquet(path).createOrReplaceTempView(name)
    opts = dict(kv.split("=", 1) for kv in a.taxonomy_option)
    taxonomy = read_taxonomy(spark, a.taxonomy_format, **opts)
    run = run_model(spark, build_model(a), taxonomy, store_root=a.store_root, write=True, parts=a.store_parts)
    print(run.path)
    return run.path


if __name__ == "__main__":
    main()
