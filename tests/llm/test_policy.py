"""Design rules checked on the operators' source."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[2]
LLM = ROOT / "adsift" / "llm"
NATIVE = ("license_scan.py", "quality.py", "line_dedup.py")
FORBIDDEN = {
    "localCheckpoint": r"localCheckpoint",
    "cross join": r"crossJoin|how=\"cross\"|, \"cross\"\)",
    "machine-local folder": r"mkdtemp|/tmp|tempfile",
    "RDD code": r"\.rdd\b|mapPartitions",
    "swallowed import error": r"except ImportError|except ModuleNotFoundError",
    "whole result on the driver": r"\.collect\(\)|toPandas\(",
}


def sources():
    return {p: p.read_text() for p in [*LLM.rglob("*.py"), ROOT / "corpus_pipeline.py"]}


def test_no_forbidden_constructs():
    hits = [(p.name, name) for p, text in sources().items() for name, pat in FORBIDDEN.items() if re.search(pat, text)]
    assert hits == []


def test_native_operators_have_no_python_on_the_executors():
    for name in NATIVE:
        assert not re.search(r"udf|mapIn|applyIn|pyarrow|pandas|numpy", (LLM / name).read_text()), name


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "adsift").rglob("*.py"):
        if LLM not in p.parents:
            assert "adsift.llm" not in p.read_text() and "from .llm" not in p.read_text(), p
