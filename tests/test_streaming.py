"""Incremental ingest: two scheduled runs see only new files; output exactly once."""

from tagloom.streaming import start_extract_stream

SEP = "\x01"


def write_lines(path, lines):
    path.mkdir(parents=True, exist_ok=True)
    with open(path / "part.txt", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_available_now_runs(spark, tmp_path):
    src, sink, ckpt = tmp_path / "src", str(tmp_path / "sink"), str(tmp_path / "ckpt")
    cols = ["id", "a", "b"]
    write_lines(src / "d1", [SEP.join(["1", "x", "y"]), SEP.join(["2", "x"]), SEP.join(["3"])])
    q = start_extract_stream(spark, str(src / "*"), cols, sink, checkpoint=ckpt)
    q.awaitTermination(120)
    assert sorted(tuple(r) for r in spark.read.parquet(sink).select(*cols).collect()) == [("1", "x", "y"), ("2", "x", "")]
    write_lines(src / "d2", [SEP.join(["4", "p", "q"])])
    q = start_extract_stream(spark, str(src / "*"), cols, sink, checkpoint=ckpt)
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(sink).select(*cols).collect())
    assert got == [("1", "x", "y"), ("2", "x", ""), ("4", "p", "q")]


def test_two_applications_keep_all_rows(tmp_path):
    """The second application finds the first one's file archived and must not start again at batch 0."""
    import os
    import subprocess
    import sys

    from tagloom.schemas import LOGS_COLUMNS

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    src, sink = tmp_path / "src", tmp_path / "sink"
    env = os.environ | {"PYTHONPATH": repo, "PYSPARK_SUBMIT_ARGS": f"--master local[2] --conf spark.checkpoint.dir={tmp_path}/shared pyspark-shell"}

    def run():
        cmd = [sys.executable, f"{repo}/tagloom/plans/jobs.py", "ingest", "--kind", "logs", "--src", str(src), "--dest", str(sink), "--stream"]
        subprocess.run(cmd, check=True, env=env, capture_output=True, timeout=300)

    def line(k):
        return SEP.join([k] + ["x"] * (len(LOGS_COLUMNS) - 1))

    write_lines(src, [line("1")])
    run()
    (src / "part.txt").rename(tmp_path / "archived.txt")
    with open(src / "later.txt", "w") as f:
        f.write(line("2") + "\n")
    run()
    import pyarrow.parquet as pq

    got = sorted(k for p in sink.glob("batch_id=*/*.parquet") for k in pq.ParquetFile(p).read(["id"])["id"].to_pylist())
    assert got == ["1", "2"]
