"""The entry module must import, and give its SQL, without a session, jars or extra packages."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code):
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_import_without_jars_or_session():
    out = run(
        "import builtins, zipfile, glob\n"
        "def no(*a, **k): raise AssertionError('file access at import')\n"
        "zipfile.ZipFile = no\nglob.glob = no\n"
        "import __spark_entry__ as E\n"
        "from pyspark.sql import SparkSession\n"
        "assert SparkSession.getActiveSession() is None\n"
        "print(len(E.queries()), len(E.oracle_sql()))")
    n_queries, n_oracle = map(int, out.split())
    assert n_queries >= 150 and n_oracle >= 134


def test_import_without_optional_packages():
    out = run(
        "import sys\n"
        "class Hide:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('shipcast.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Hide())\n"
        "import __spark_entry__ as E\n"
        "print(any(k.startswith('op') or k == 'pipeline' for k in E.queries()))")
    assert out.strip() == "False"


def test_shipped_archive_holds_every_package(spark, tmp_path):
    """Executors have the package only as the archive; from another folder every module must import from it."""
    from pyspark import SparkFiles

    from shipcast.session import ship_package

    ship_package(spark)
    names = sorted(p.replace(os.sep, ".")[:-3] for folder in ("functions", "sources", "operators", "streaming", "llm")
                   for p in (os.path.join("shipcast", folder, n) for n in os.listdir(os.path.join(ROOT, "shipcast", folder)))
                   if p.endswith(".py") and not p.endswith("__init__.py"))
    assert "shipcast.sources.market_csv" in names
    code = f"import sys, importlib\nsys.path.insert(0, {SparkFiles.get('shipcast.zip')!r})\n" + "".join(
        f"assert '.zip' in importlib.import_module({n!r}).__file__\n" for n in names)
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr[-2000:]
