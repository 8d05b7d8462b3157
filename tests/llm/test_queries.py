"""The registered queries of this package against their SQL, and on workers that do not have it."""

import os
import subprocess
import sys

import pytest

from marquee.llm.queries import CHECK_SQL, QUERIES
from tests.check import compare

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"

ALONE = """
import sys
sys.path.insert(0, {root!r})
from marquee.llm.queries import QUERIES
from marquee.session import get_session

spark = get_session("alone", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})

def known(batches):
    import importlib.util
    for b in batches:
        yield b.assign(id=int(importlib.util.find_spec("marquee") is not None))

assert spark.range(1).mapInPandas(known, "id long").first()[0] == 0, "the worker sees the package"
for name in {names!r}:
    print(name, QUERIES[name](spark, {sf!r}).count())
spark.stop()
"""


@pytest.mark.parametrize("name", sorted(CHECK_SQL))
def test_query_equals_its_sql(spark, name):
    problem, rows = compare(spark, SF, QUERIES[name], CHECK_SQL[name])
    assert problem is None and rows


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Everything that runs in Python workers is sent along, models in broadcasts too."""
    names = [n for n in QUERIES if n.split("_")[0] in ("op1", "op2", "op4", "op5", "op8", "op11", "op12", "op13")]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", ALONE.format(root=ROOT, names=names, sf=SF)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900, check=False
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split("\n")) > len(names)
