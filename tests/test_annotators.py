"""The classifiers and their registry on literal texts."""

import pytest

from dialoom.operators import annotations as store_ops
from dialoom.operators import annotators

PAIRS = {
    "wiki": ("assistant", "Of [[one]] [[two]] and [[three]]"),
    "head": ("assistant", "## A heading \nand a [[link]]"),
    "bold": ("assistant", "  **Bold words**\n[[link]]"),
    "part": ("assistant", "**Bold** - more\n[[link]]"),
    "blank": ("assistant", "#\n[[]]"),
    "untitled": ("assistant", "# No links here"),
    "shell": ("assistant", "Try\n#!/usr/bin/env python3\nimport os\n"),
    "c": ("assistant", '#include <a.h>\nint x;'),
    "functions": ("assistant", "def f (x): pass\nfunction g (y) {}\nconst h = (a, b) => a\nlet k = require ('k')"),
    "fence": ("assistant", "```Rust\nx\n```"),
    "display": ("assistant", "$$x\n+ y$$"),
    "bracket": ("assistant", "\\[z\\] and $a$ and \\frac{a}{b}"),
    "prices": ("assistant", "It costs $5 or $$"),
    "user": ("user", "[[a]] ```x``` $$y$$"),
    "null": ("assistant", None),
    "empty": ("assistant", ""),
}
WANT = {
    ("wiki", "exchange_type", "wiki_article", 0.95), ("wiki", "wiki_link_count", "3.0", 1.0),
    ("head", "exchange_type", "wiki_article", 0.8), ("head", "wiki_link_count", "1.0", 1.0), ("head", "proposed_title", "A heading", 0.8),
    ("bold", "exchange_type", "wiki_article", 0.8), ("bold", "wiki_link_count", "1.0", 1.0), ("bold", "proposed_title", "Bold words", 0.8),
    ("part", "exchange_type", "wiki_article", 0.8), ("part", "wiki_link_count", "1.0", 1.0), ("part", "proposed_title", "Bold", 0.8),
    ("blank", "exchange_type", "wiki_article", 0.8), ("blank", "wiki_link_count", "1.0", 1.0),
    ("shell", "has_code", None, 0.95), ("shell", "code_evidence", "shebang", None), ("shell", "code_evidence", "python_import", None),
    ("c", "has_code", None, 0.95), ("c", "code_evidence", "c_include", None),
    ("functions", "has_code", None, 0.75), *[("functions", "code_evidence", x, None) for x in ("python_function", "js_function", "arrow_function", "js_require")],
    ("fence", "has_code", None, 0.95), ("fence", "code_evidence", "code_block", None),
    ("display", "has_latex", None, 0.95), ("display", "latex_type", "display", None),
    ("bracket", "has_latex", None, 0.95), *[("bracket", "latex_type", x, None) for x in ("display", "inline", "commands")],
}


def pair_rows(spark, pairs=PAIRS):
    return spark.createDataFrame([(k, role, text, "clash") for k, (role, text) in pairs.items()], "prompt_response_id string, response_role string, response_text string, key string")


def test_pairs(spark):
    store = annotators.run_registry(pair_rows(spark).drop("key"), store_ops.empty_store(spark), annotators.PAIR_ANNOTATORS)
    rows = store.collect()
    assert len(rows) == len(WANT) and {(r["entity_id"], r["key"], r["value"], r["confidence"]) for r in rows} == WANT
    one_by_one = store_ops.empty_store(spark)
    for a in annotators.PAIR_ANNOTATORS:
        one_by_one = store_ops.write(one_by_one, annotators.annotate(pair_rows(spark), a, one_by_one))
    assert sorted(map(str, one_by_one.collect())) == sorted(map(str, rows))


def test_registry_reads_the_store(spark):
    assert [[a.name for a in s] for s in annotators.stages(annotators.PAIR_ANNOTATORS)] == [["wiki_candidate", "has_code", "has_latex"], ["naive_title"]]
    old = spark.createDataFrame([("prompt_response", "fence", "has_code", "flag", None, 1.0, "by hand", "user", "1", None), ("prompt_response", "untitled", "exchange_type", "string", "wiki_article", 1.0, None, "user", "1", None)], store_ops.SCHEMA)
    rows = {(r["entity_id"], r["key"], r["value"]): r for r in annotators.run_registry(pair_rows(spark), old, annotators.PAIR_ANNOTATORS).collect()}
    assert ("fence", "code_evidence", "code_block") not in rows and rows["fence", "has_code", None]["reason"] == "by hand"
    assert rows["untitled", "proposed_title", "No links here"]["reason"] == "markdown_header"
    assert annotators.run_registry(pair_rows(spark).limit(0), old, annotators.PAIR_ANNOTATORS).count() == 2


def test_parts(spark):
    texts = {"a": ("assistant", "text", "```Py\nx\n``` and ```\ny\n``` and ```py\nz```"), "u": ("user", "text", "#!/bin/bash\n[[a]]"), "i": ("user", "text", "#include <x>"), "p": ("assistant", "text", "<?PHP echo"), "l": ("assistant", "text", "[[a]] [[]] [[b]]"), "m": ("assistant", "text", "$x$"), "k": ("assistant", "code", "[[a]]"), "n": ("assistant", "text", None)}
    rows = spark.createDataFrame([(k, *v) for k, v in texts.items()], "content_part_id string, role string, part_type string, text_content string")
    got = {(r["entity_id"], r["key"], r["value"], r["reason"]) for r in annotators.run_registry(rows, store_ops.empty_store(spark), annotators.PART_ANNOTATORS).collect()}
    assert got == {
        ("a", "has_code_block", None, "markdown_code_block"), ("a", "code_block_count", "3.0", None), ("a", "code_language", "py", "code_block_language_spec"),
        ("u", "has_script_header", None, "shebang"), ("u", "script_type", "bash", "shebang_interpreter"),
        ("i", "has_script_header", None, "c_include"), ("i", "script_type", "c", None),
        ("p", "has_script_header", None, "php_tag"), ("p", "script_type", "php", None),
        ("l", "has_wiki_links", None, "wiki_links_detected"), ("l", "wiki_link_count", "2.0", None),
        ("m", "has_latex", None, "latex_notation_detected"), ("m", "latex_type", "inline", None),
    }


@pytest.mark.parametrize("version", ["1.0", "2.0"])
def test_own_annotators(spark, version):
    own = annotators.Annotator("own", 99, lambda: annotators.F.array(annotators.annotation("seen", "flag")), version=version, role=None)
    assert [len(s) for s in annotators.stages([own, *annotators.PAIR_ANNOTATORS])] == [1, 3, 1]
    rows = annotators.run_registry(pair_rows(spark), store_ops.empty_store(spark), [own]).collect()
    assert len(rows) == len(PAIRS) and {r["source_version"] for r in rows} == {version}
