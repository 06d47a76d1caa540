"""The collection gate in its own zone."""

import pytest
from pyspark.sql import functions as F

from tickframe.functions.times import SEOUL, collection_open


@pytest.mark.parametrize(
    "moment,is_open",
    [
        ("2024-01-03 15:00:00", True),  # Wednesday, New York trades, after midnight in Seoul
        ("2024-01-03 01:00:00", False),
        ("2024-01-05 18:00:00", True),  # Friday in New York, Saturday 03:00 in Seoul
        ("2024-01-06 15:00:00", False),
        ("2024-01-07 18:00:00", False),  # Sunday in New York, Monday 03:00 in Seoul
    ],
)
def test_gate(spark, moment, is_open):
    assert collection_open(spark, F.lit(moment).cast("timestamp"), SEOUL) is is_open


def test_the_entry_works_without_the_corpus_operators(tmp_path):
    """Also where a library they need is missing."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "numpy.py").write_text("raise ImportError('absent')")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'daily_ma7' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": f"{tmp_path}:{root}"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
