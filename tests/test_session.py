"""Session sizing and the shared folder."""

import os
import subprocess
import sys

from vacancylens.session import shuffle_partitions, work_folder


def test_shuffles_grow_with_the_input():
    assert [shuffle_partitions(n) for n in (0, 1 << 30, 100 << 40)] == [200, 200, 409_600]


def test_work_folders_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "a"), work_folder(spark, "a")
    assert first != second and first.startswith(f"{shared}/a-")


def test_pages_are_read_from_any_folder(tmp_path):
    """Python workers get the package even where only the driver can import it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from vacancylens.session import build_session\n"
            "from vacancylens.operators.extract import extract_cards\n"
            "s = build_session('any', 'local[1]', spark__ui__enabled='false')\n"
            "p = s.createDataFrame([(1, 'u', '<div class=css-pkv5jc>x</div>')], 'page_id long, url string, html string')\n"
            "assert extract_cards(p).count() == 1 and extract_cards(p).first()['all_text'] == ['x']\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and "SPARK" not in k}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True,
                          timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
