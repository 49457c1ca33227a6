"""The checkpoint folder of a session that does not name one."""
import os
import subprocess
import sys
from pathlib import Path

CODE = """
from ratecast.session import checkpoint_dir, get_spark, materialize
spark = get_spark("plain", master="local[1]", shuffle_partitions=1)
assert spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getConf().get("spark.checkpoint.dir", None) is None
d = checkpoint_dir(spark)
assert checkpoint_dir(spark) == d and materialize(spark.range(3)).count() == 3
spark.range(2).write.parquet(d + "/t")
assert spark.read.parquet(d + "/t").count() == 2
print("made", d)
"""


def test_plain_session_without_a_checkpoint_setting(tmp_path):
    conf = tmp_path / "conf"
    conf.mkdir()
    (conf / "spark-defaults.conf").write_text("")
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"SPARK_CONF_DIR": str(conf), "TMPDIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=Path(__file__).resolve().parents[1], env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0 and "made" in done.stdout, done.stderr[-2000:]
