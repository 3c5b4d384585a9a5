"""Broken prompt and response pairs.

Prompt and response are aligned as token sequences: shingle containment finds
candidate copies, the longest common subsequence (bit-parallel) decides them;
the same alignment matches the sentences of an answer with refusal templates
(module ``refusals``). The remaining defects follow from the form of the answer
and the stored word count.

A pair has at most one defect, the first of ``DEFECTS`` that holds. Defined
results: a NULL prompt can't be copied and has no language, so only the
answer's own defects count; a NULL stored count is no evidence; texts of any
length are read whole; repeated rows of a pair give one row.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import language, refusals
from .bpe import spread

DEFECTS = ("empty", "copies_prompt", "refusal", "truncated", "other_language")

# Stand-ins for a missing answer, compared without case, marks and brackets.
STAND_INS = frozenset(
    ["na", "n a", "null", "none", "nil", "nan", "undefined", "empty", "blank", "void", "missing", "no answer", "no response", "no reply", "no content", "no text", "no output", "no data", "not available", "not provided", "no answer provided", "no response provided", "empty response", "empty answer", "response missing", "answer missing", "tbd", "todo", "placeholder", "pending", "error", "keine antwort", "sin respuesta", "sem resposta", "sans réponse", "pas de réponse", "aucune réponse", "brak odpowiedzi", "нет ответа", "без ответа", "回答なし", "無回答", "返答なし"]
)
BARE_ONLY = frozenset(["none", "error", "pending", "missing", "empty", "blank", "void", "nan", "nil"])
UNSEEN = r"\p{P}\p{Z}\p{C}\p{Sk}\p{Sm}\p{Mn}ᅟᅠㅤﾠ⠀\s"
INVISIBLE = regex.compile(f"[{UNSEEN}]+")
VISIBLE = regex.compile(f"[^{UNSEEN}]")
LONGEST_STAND_IN = max(map(len, STAND_INS))
#: words, and single characters of scripts that don't part them
TOKEN = re.compile("[\u3041-\u30ff\u3400-\u9fff]|[0-9A-Za-z\u00aa\u00b5\u00ba\u00c0-\u1fff\u2c00-\u2dff\ua640-\ud7ff\uf900-\ufdff]+")

# Courtesy around a refusal.
COURTESIES = (
    "thanks for asking|thank you for your question|thank you for understanding|i appreciate your patience|i understand this matters to you|i understand your request|i hope you understand|i apologize for the inconvenience|sorry about that|is there something else you would like to talk about|is there anything else i can help with|please let me know if you have another question|feel free to ask me something else|a specialist may be a better person to ask|please consult a professional|"
    "danke für die frage|ich bitte um verständnis|kann ich sonst etwas für dich tun|vielen dank für dein verständnis|merci pour la question|merci de votre compréhension|puis-je vous aider autrement|gracias por preguntar|gracias por entenderlo|quieres hablar de otra cosa|puedo ayudarte con otra cosa|"
    "obrigado pela pergunta|obrigado pela compreensão|posso ajudar em outra coisa|dziękuję za pytanie|dziękuję za zrozumienie|czy mogę pomóc w czymś innym|спасибо за вопрос|спасибо за понимание|могу ли я помочь с чем-то ещё|ご質問ありがとうございます|ほかにご質問はありますか|ご理解ください|ご理解いただければ幸いです|何かほかにお手伝いできますか"
).split("|")
# Prompts that ask for a repetition, a refusal, another language.
ASKS_REPEAT = regex.compile(
    r"(?:^|[.!?:。！？\n\"“]\s*|please |can you |could you )(?:repeat|copy|echo|write out|restate|recite|say)\s+(?:this|the|after|back|exactly|it|that|these|following|verbatim|my)\b|\bword for word\b|\bverbatim\b|wort für wort|wörtlich wieder|(?:^|[.!?\n]\s*)wiederhol(?:e|en sie)?\b|mot pour mot|mot à mot|(?:^|[.!?\n]\s*)(?:répète|répétez|recopie|recopiez)\b|palabra por palabra|(?:^|[.!?\n]\s*)(?:repite|repita|copia|copie)\s+(?:esta|este|la|el|lo|estas|estos)\s+(?:l[íi]nea|frase|texto|oraci[óo]n|siguiente|que)|palavra por palavra|(?:^|[.!?\n]\s*)(?:repita|copie|repete)\s+(?:esta|este|a|o)\s+(?:linha|frase|texto)|słowo w słowo|(?:^|[.!?\n]\s*)(?:powtórz|przepisz|skopiuj)\b|слово в слово|(?:^|[.!?\n]\s*)(?:повтори|перепиши|скопируй)(?:те)?\b|そのまま(?:繰り返|書き写|コピー)|繰り返してください|復唱して",
    regex.I,
)
ASKS_REFUSAL = regex.compile(
    r"\b(?:decline|refus(?:e|al)|reject(?:ion)?|turn(?:ing)? down|cancel)\b[^.?!]*\b(?:invitation|offer|request|note|letter|email|message|politely|proposal)|\b(?:write|draft|compose|prepare|formulate|word|phrase)\b[^.?!]*\b(?:declin|refus|reject|turn(?:ing)? down)|absage|ablehnung|(?:lettre|mot|message|note|refus)\b[^.?!]*\b(?:refus|déclin)|refus poli|rechaz[^.?!]*invitaci|nota[^.?!]*(?:rechaz|declin|recus)|negativa|recus[^.?!]*convite|odmow|odmówi|odmaw|отказ|断る|お断り|辞退",
    regex.I,
)
ASKS_LANGUAGE = regex.compile(
    r"\btranslat|\b(?:answer|reply|respond|write|explain|say)\b[^.?!\n]{0,40}\bin (?:english|german|french|spanish|portuguese|polish|russian|japanese)\b|übersetz|(?:auf|ins) (?:englisch|deutsch|französisch|spanisch|portugiesisch|polnisch|russisch|japanisch)|\btradui|\btraduction|\b(?:en|in) (?:anglais|allemand|français|espagnol|portugais|polonais|russe|japonais)\b|\btraduc|\btraduz|\btradução|\b(?:en|al) (?:inglés|alemán|francés|español|portugués|polaco|ruso|japonés)\b|\b(?:em|para o) (?:inglês|alemão|francês|espanhol|português|polonês|russo|japonês)\b|przetłumacz|tłumacz|\bpo (?:angielsku|niemiecku|francusku|hiszpańsku|portugalsku|polsku|rosyjsku|japońsku)\b|перевед|перевод|\bпо-(?:английски|немецки|французски|испански|португальски|польски|русски|японски)|\bна (?:английский|немецкий|французский|испанский|португальский|польский|русский|японский|английском|немецком|французском|испанском|русском)|翻訳|訳して|(?:英|ドイツ|フランス|スペイン|ポルトガル|ポーランド|ロシア|日本)語(?:に|で)",
    regex.I,
)
CUT_MARK = regex.compile(r"(?:\.\.\.|…|\[\s*(?:…|\.\.\.|truncated|cut off|cut|continued|snip)\s*\]|\(\s*(?:truncated|cut off|continued)\s*\))\s*$", regex.I)
FULL_STOP = regex.compile(r"[.!?。！？؟\p{Extended_Pictographic}️‍]$")
CLOSERS = "”»“’\"')]}）」』】*_`>|"
ITEM = re.compile(r"^\s*(?:[-*•–]|\d{1,3}[.)．、])(?:\s+|$)(.*)$")
ANNOUNCED = re.compile(r"(?<![\d.,#:/v])(\d{1,2})(?![\d.,:/%]\d|\s?%).{0,60}[:：]\s*$")
URL_END = re.compile(r"(?:https?://|www\.)\S+$")
SENTENCE = re.compile(r"[^.!?。！？\n]+")
OPENERS = re.compile("[(\\[{（「]")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower().replace("’", "'"))


def lcs(a: Sequence[str], b: Sequence[str]) -> int:
    """Length of the longest common subsequence, a machine word at a time."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & at.get(y, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """Pairs of neighbouring words; of a single word, itself."""
    return set(zip(words, words[1:])) if len(words) > 1 else {tuple(words)}


def is_empty(text: str | None) -> bool:
    if text is None or not (seen := VISIBLE.search(text)):
        return True
    # a stand-in is short: what has more visible signs than any of them is none
    n = 0
    for n, _ in enumerate(VISIBLE.finditer(text, seen.start()), 1):
        if n > LONGEST_STAND_IN:
            return False
    bare = text.strip()
    core = INVISIBLE.sub(" ", bare).strip().lower()
    if core in STAND_INS:
        # words that can answer a question count only without a full stop
        return core not in BARE_ONLY or not bare.endswith((".", "!", "?"))
    return False


def letters_lcs(p: list[str], r: list[str]) -> int:
    """Letters of a common subsequence of two texts, between shared anchors.

    Word pairs that each text has once, in the longest run of them that keeps
    its order in both, are anchors; the letters between two anchors are
    aligned by themselves, so time follows the gaps, not the product of the
    texts.
    """
    once = lambda w: {k: i for k, (i, n) in _places(w).items() if n == 1}
    a, b = once(p), once(r)
    shared = sorted((i, b[k]) for k, i in a.items() if k in b)
    same, i0, j0 = 0, 0, 0
    for i, j in [*_increasing(shared), (len(p), len(r))]:
        if i >= i0 and j >= j0:
            same += lcs("".join(p[i0:i]), "".join(r[j0:j]))
            if i < len(p):
                same += len(p[i]) + len(p[i + 1])
            i0, j0 = i + 2, j + 2
    return same


def _places(words: list[str]) -> dict[tuple[str, str], tuple[int, int]]:
    out: dict[tuple[str, str], tuple[int, int]] = {}
    for i, pair in enumerate(zip(words, words[1:])):
        out[pair] = (i, out.get(pair, (0, 0))[1] + 1)
    return out


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first, whose seconds increase."""
    ends: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        ends[k : k + 1] = [j]
        last[k : k + 1] = [n]
        before[n] = last[k - 1] if k else -1
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def copies(prompt: str, response: str) -> bool:
    """Nothing but the prompt again: the alignment leaves little of either.

    Framing may add up to six tokens (or a tenth); the prompt may lose up to a
    tenth, at least one token. A response that repeats the prompt is
    compared with as many prompts.
    """
    p, r = tokens(prompt), tokens(response)
    if not p or not r:
        return False
    if p == r:
        return True
    times = max(1, round(len(r) / len(p)))
    slack = max(6, len(p) * times // 10)
    if abs(len(r) - len(p) * times) > 2 * slack:
        return False
    if len(p) > 3 and not set(p) & set(r):
        return False
    if times > 1:
        p = p * times
    a, b = shingles(p), shingles(r)
    close = len(a & b) / min(len(a), len(b))
    if close < 0.2 and len(p) > 3:
        return False
    same = lcs(p, r)
    lost = max(1, len(p) // 10)
    if len(p) - same <= lost and len(r) - same <= slack and same >= 0.5 * len(r):
        return True
    # misspelt words: the same alignment over letters
    x, y = sum(map(len, p)), sum(map(len, r))
    if min(x, y) < 0.92 * x or min(x, y) < 0.6 * y or y - min(x, y) > max(0.08 * y, 24):
        return False
    same = letters_lcs(p, r)
    return x - same <= 0.08 * x and y - same <= max(0.08 * y, 24 if close > 0.5 else 0) and same >= 0.6 * y


GRAMMAR = refusals.Grammar(tokens, lcs)


@lru_cache(maxsize=1)
def _courtesies() -> tuple[list[list[str]], dict[str, list[int]]]:
    """Words of each courtesy, and an index by word."""
    out = [tokens(line) for line in COURTESIES]
    index: dict[str, list[int]] = {}
    for i, words in enumerate(out):
        for w in set(words):
            index.setdefault(w, []).append(i)
    return out, index


def _courteous(words: list[str]) -> bool:
    """Whether a sentence has the words of a courtesy in order and few others."""
    known, index = _courtesies()
    shared = Counter(i for w in set(words) for i in index.get(w, ()))
    for i, n in shared.items():
        line = known[i]
        if n >= 0.56 * len(set(line)) and 0.7 * len(line) <= len(words) <= len(line) + 2 and lcs(line, words) >= 0.8 * len(line):
            return True
    return False


def is_refusal(response: str) -> bool:
    """Every sentence is a refusal or courtesy, and one is a refusal."""
    seen = False
    for s in SENTENCE.finditer(response.strip().strip("*_>\"“”#` \n")):
        if w := tokens(s[0]):
            if GRAMMAR.refuses(w):
                seen = True
            elif not _courteous(w):
                return False
    return seen


def _open_bracket(line: str) -> bool:
    """Whether the line ends inside a bracket (emoticons and item marks aside)."""
    stack = []
    pairs = {")": "(", "]": "[", "}": "{", "）": "（", "」": "「"}
    for i, c in enumerate(line):
        if c in "([{（「" and not (c == "(" and i and line[i - 1] in ":;="):
            stack.append(c)
        elif c in pairs and stack and stack[-1] == pairs[c]:
            stack.pop()
    return bool(stack)


def is_truncated(response: str, stored: int | None) -> bool:
    """The answer stops early, by its form or by the stored word count."""
    text = response.strip()
    if stored is not None:
        # pieces between runs of blanks, as the count has them: blanks at an end part an empty one
        there = len(response.split()) + (response[:1].isspace()) + (response[-1:].isspace())
        if stored > 1.1 * there:
            return True
    if text.count("```") % 2:
        return True
    if text.endswith(("...", "…", "]", ")")) and CUT_MARK.search(text, max(0, text.rfind("\n"))):
        return True
    lines = text.split("\n")
    last = lines[-1].strip()
    in_code = last.startswith("```")
    if not in_code and OPENERS.search(last) and _open_bracket(last):
        return True
    if not in_code and last.replace("```", "").count("`") % 2:
        return True
    # a list shorter than announced
    fenced = False
    for i, line in enumerate(lines if ":" in text or "：" in text else ()):
        if line.lstrip().startswith("```"):
            fenced = not fenced
        if fenced or not line.rstrip().endswith((":", "：")) or ITEM.match(line) or not (m := ANNOUNCED.search(line)):
            continue
        n, j, items = int(m[1]), i + 1, 0
        while j < len(lines) and (not lines[j].strip() or ITEM.match(lines[j]) or (items and lines[j].startswith((" ", "\t")))):
            if (it := ITEM.match(lines[j])) and it[1].strip():
                items += 1
            j += 1
        if 2 <= n <= 50 and items < n and (items or j >= len(lines)):
            return True
    if in_code:
        return False
    if m := ITEM.match(last):
        if not m[1].strip():
            return True
        others = [x[1].strip() for x in map(ITEM.match, lines[:-1]) if x and x[1].strip()]
        return bool(others) and all(FULL_STOP.search(x.rstrip(CLOSERS)) for x in others) and not FULL_STOP.search(m[1].strip().rstrip(CLOSERS))
    if last.startswith("|"):
        head = next((x.strip() for x in lines if x.strip().startswith("|")), last)
        return not last.endswith("|") or last.count("|") < head.count("|")
    if last.startswith("#") and not last.startswith("#!"):
        return False
    if FULL_STOP.search(last) or URL_END.search(last) or last[-1:] in CLOSERS:
        return False
    if len(lines) == 1 and len(tokens(last)) <= (4 if language.KANA.search(last) or language.HAN.search(last) else 2):
        return False  # a short answer needs no mark
    return True


def asks_language(prompt: str) -> bool:
    """Whether the prompt asks for an answer in some language."""
    return bool(ASKS_LANGUAGE.search(language.plain(prompt)) or ASKS_LANGUAGE.search(prompt[: prompt.find(":") + 1]))


def in_other_language(prompt: str, response: str) -> bool:
    theirs = language.main_language(prompt)
    if theirs is None:
        return False
    plain = language.plain(response)
    if language.clearly(plain, theirs):
        return False
    by = language.shares(plain, True)
    if by:
        other = sum(n for lang, n in by.items() if lang != theirs)
        differs = 2 * other > sum(by.values())
    else:
        ours = language.detect(plain, 1.4)
        differs = ours is not None and ours != theirs
    return differs and not asks_language(prompt)


def defect(prompt: str | None, response: str | None, stored: int | None) -> str | None:
    """The one defect of a pair, or None. Cheap tests come first."""
    if is_empty(response):
        return "empty"
    copied = prompt is not None and copies(prompt, response)
    if copied and not ASKS_REPEAT.search(prompt):
        return "copies_prompt"
    if is_refusal(response) and not (prompt is not None and ASKS_REFUSAL.search(prompt)):
        return "refusal"
    if not copied and is_truncated(response, stored):
        return "truncated"
    if prompt is not None and in_other_language(prompt, response):
        return "other_language"
    return None


def flag_pairs(pairs: DataFrame) -> DataFrame:
    """prompt_response_id and defect of each defective pair.

    ``pairs`` has prompt_response_id, prompt_text, response_text and
    response_word_count; other columns are ignored, rows without an id left
    out. Rows are judged where they lie; only the flagged ones are shuffled.
    Should versions of a pair differ, the first of ``DEFECTS`` counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for i, p, r, n in zip(*(c.to_pylist() for c in b.columns)):
                if d := defect(p, r, n):
                    ids.append(i)
                    out.append(DEFECTS.index(d))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.int32())], ["prompt_response_id", "rank"])

    rows = pairs.where("prompt_response_id is not null").select("prompt_response_id", "prompt_text", "response_text", "response_word_count")
    flagged = spread(rows).mapInArrow(run, "prompt_response_id string, rank int").groupBy("prompt_response_id").agg(F.min("rank").alias("rank"))
    return flagged.select("prompt_response_id", F.element_at(F.array(*map(F.lit, DEFECTS)), F.col("rank") + 1).alias("defect"))
