import pytest

from dialoom.llm import pair_defects as d

Q = "What should I do when the printer refuses every page?"
A = "Open the tray and remove the paper. Then start the printer again and wait for a minute."
CASES = [
    (Q, A, 17, None),
    (Q, None, 0, "empty"),
    (Q, "", 1, "empty"),
    (Q, " ​﻿\n", None, "empty"),
    (Q, "**  **", 1, "empty"),
    (Q, "…", 1, "empty"),
    (Q, "[no answer]", 2, "empty"),
    (Q, "N/A", 1, "empty"),
    (Q, "Yes", 1, None),
    (Q, "None.", 1, None),
    (Q, "705", 1, None),
    (Q, "👍", 1, None),
    (Q, A, 40, "truncated"),
    (Q, A, 18, None),
    (Q, A, None, None),
    (Q, "Open the tray and remove the", 6, "truncated"),
    (Q, "Open the tray (see the picture. Then remove", 8, "truncated"),
    (Q, "Open the tray and ...", 5, "truncated"),
    (Q, "Open the tray and wait [truncated]", 6, "truncated"),
    (Q, "Here is a script.\n\n```python\nprint(1)", 6, "truncated"),
    (Q, "Here is a script.\n\n```python\nprint(1)\n```", 7, None),
    (Q, "You need 3 steps:\n1. Open the tray\n2. Wait", 9, "truncated"),
    (Q, "You need 2 steps:\n1. Open the tray\n2. Wait a bit", 11, None),
    (Q, "You need 3 steps:\n- Open the tray.\n- Wait.\n-", 10, "truncated"),
    (Q, "| a | b |\n|---|---|\n| 1 | 2 |", 12, None),
    (Q, "See the manual of the device. https://a.example/manual", 7, None),
    (Q, "WHAT SHOULD I DO WHEN THE PRINTER REFUSES EVERY PAGE?", 10, "copies_prompt"),
    (Q, "Your question was: What should I do when the printer refuses page", 12, "copies_prompt"),
    (Q, Q + "\n" + Q, 20, "copies_prompt"),
    (Q, "What shuold I do when teh printer refuzes every page?", 10, "copies_prompt"),
    (Q, Q + "\n\n" + A, 27, None),
    ("Repeat this line word for word: The tray is open.", "The tray is open.", 4, None),
    (Q, "I'm sorry, but I can't help with that.", 8, "refusal"),
    (Q, "Thanks for asking. Helping with the old printer is not something I am able to do. I hope you understand.", 20, "refusal"),
    (Q, "I'm sorry this cost you an evening. " + A, 24, None),
    ("Write a polite note in which I decline an invitation.", "Unfortunately I have to decline this one.", 7, None),
    (Q, "Über den Drucker darf ich hier nicht sprechen.", 8, "refusal"),
    (Q, "Öffne das Fach und nimm das Papier heraus. Dann starte das Gerät neu und warte eine Minute.", 17, "other_language"),
    ("Translate into German: “The tray is open.”", "Das Fach ist offen und das Papier ist da.", 9, None),
    ("Was mache ich, wenn der Drucker nicht geht?", "Open the tray and remove the paper. Then wait for a minute.", 12, "other_language"),
    ("Was mache ich, wenn der Drucker nicht geht?\n\n“The printer is on fire and the office is closed.”", "Ruf die Feuerwehr und verlass das Haus.", 7, None),
    ("なぜ夜行列車は遅れますか？", "線路の点検が続いているからです。", 1, None),
    (None, A, 17, None),
    (None, "I'm sorry, but I can't help with that.", 8, "refusal"),
    ("", "", None, "empty"),
]


@pytest.mark.parametrize("prompt,response,stored,want", CASES)
def test_cases(prompt, response, stored, want):
    assert d.defect(prompt, response, stored) == want


def test_long_texts():
    long = "The tray opens and the paper moves. " * 20_000
    assert d.defect(long, long, None) == "copies_prompt"
    assert d.defect(Q, long, None) is None


def test_lcs():
    assert d.lcs(list("abcbdab"), list("bdcaba")) == 4 and d.lcs([], ["a"]) == 0


def test_frame(spark):
    rows = [("a", Q, None, 0, "x"), ("a", Q, None, 0, "x"), ("b", Q, A, 17, "x"), (None, Q, None, 0, "x"), ("c", None, "", None, None)]
    df = spark.createDataFrame(rows, "prompt_response_id string, prompt_text string, response_text string, response_word_count int, defect string")
    assert sorted(map(tuple, d.flag_pairs(df).collect())) == [("a", "empty"), ("c", "empty")]
    assert d.flag_pairs(df.limit(0)).collect() == []
