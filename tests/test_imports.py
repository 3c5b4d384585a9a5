"""The library stands without its text subpackage."""

import pathlib
import re


def test_nothing_else_imports_llm():
    root = pathlib.Path(__file__).parents[1] / "dialoom"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
