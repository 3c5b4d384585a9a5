"""Garbled text from wrong character encoding.

A garbled word is read as the output of a noisy channel: right text, encoded
in one code and decoded with another. For each word the channels are undone on
a byte lattice, a wildcard standing for every byte that was lost; the readings
are weighed by the word frequencies of the whole corpus (a join of readings
with word counts, nothing is collected). Within a document a Viterbi search
over its words decides: its states are the channels and "unchanged", a reading
emits its log odds against the word as it stands, and leaving "unchanged" or
changing the channel costs. A document is garbled if its best path leaves
"unchanged" anywhere, and its restored text is what that path reads.

Channels are UTF-8 seen through a single-byte or multi-byte code (also twice),
one legacy code seen through another (these rest on the frequencies), a wide
legacy code seen through a single-byte one (a line at a time, as its characters
don't keep to words), and bytes lost for good: a word with a replacement
character can't be right, and reads as the corpus word that fits around it or,
if there is none, as itself.

Defined results: NULL, empty and sound texts give no row; a garbled sequence
whose right form stands beside it in the same line is a citation, which is
neither evidence nor restored; repeated texts are judged alike, and a garbled
word's copies count once; a word that a document repeats is evidence once;
whole texts of any length are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Codes that UTF-8 text may have been decoded with.
SEEN_AS = ("cp1252", "latin-1", "iso8859-15", "mac_roman", "cp437", "cp850", "cp1250", "cp1254", "cp1257", "iso8859-2", "cp1251", "koi8-r", "cp866", "cp852")
SEEN_AS_WIDE = ("cp932", "gbk", "big5", "euc_jp", "euc_kr")
# Fixed values: (decoded with, written in) for legacy codes.
LEGACY = tuple(
    (seen, true)
    for seen, trues in {
        "cp1252": ("cp1251", "koi8-r", "cp866", "iso8859-5", "mac_roman", "cp437", "cp850", "cp1250", "iso8859-2", "cp852", "cp1253"),
        "latin-1": ("cp1251", "koi8-r", "iso8859-5", "iso8859-2", "cp437", "cp850", "cp1250", "mac_roman", "cp852"),
        "cp1250": ("cp1252", "cp437", "cp850", "cp852", "mac_roman"),
        "iso8859-2": ("cp1252", "cp1250"),
        "cp1251": ("koi8-r", "cp866", "iso8859-5", "cp1252", "mac_roman"),
        "koi8-r": ("cp1251", "cp866", "iso8859-5"),
        "cp866": ("cp1251", "koi8-r"),
        "iso8859-5": ("cp1251", "koi8-r", "cp866"),
        "cp437": ("cp1252", "cp1250", "mac_roman", "cp850"),
        "cp850": ("cp1252", "cp1250", "cp1251", "iso8859-2", "mac_roman"),
        "cp852": ("cp1250", "iso8859-2", "cp1252"),
        "mac_roman": ("cp1252", "cp1250", "cp850", "cp1251", "iso8859-2", "cp437"),
        "mac_cyrillic": ("cp1251", "koi8-r"),
        "cp1257": ("cp1252", "cp1250"),
        "cp1254": ("cp1250", "cp1251"),
        "cp1253": ("cp1252",),
    }.items()
    for true in trues
)
WIDE_LEGACY = tuple((seen, true) for seen in ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8-r") for true in ("cp932", "euc_jp"))
BEAM = 12
# Fixed value: copies of a text that support its words as right ones.
COPIES = 6
# What a change of channel costs: to one of UTF-8 or back to
# unchanged, to a legacy code, to that at a word that looks right as it is.
CHANGE, LEGACY_CHANGE, PLAIN_CHANGE = 1.0, 2.5, 3.0
# Fixed value: log odds of a word with a replacement character against its being right.
LOST_ODDS = 4.0
LOST_CHANNEL = "utf-8>lost"
LOST = "�"
# A word: ASCII letters and everything beyond ASCII but wide blanks and marks.
WORD_CLASS = r"[A-Za-z\u0080-῿‐-‧‰-⿿〃-￿\U00010000-\U0010ffff]+"
JAVA_WORD = r"[A-Za-z\x{0080}-\x{1fff}\x{2010}-\x{2027}\x{2030}-\x{2fff}\x{3003}-\x{ffff}\x{10000}-\x{10ffff}]+"
WORD = regex.compile(WORD_CLASS)
KANA = regex.compile("[\u3041-\u30fe]")
# No right word: two and more Latin letters, none of them plain.
DENSE = regex.compile(r"(?:(?![A-Za-z])\p{Latin}){2,}")
NATURAL = regex.compile(r"(?:\p{Lu}?[\p{Ll}\p{Lo}\p{M}’']+|\p{Lu}+)(?:[-’'](?:\p{Lu}?[\p{Ll}\p{Lo}\p{M}]+|\p{Lu}+))*")
# Marks that stand sound beside a garbled word.
TYPOGRAPHIC = "“”„‘’«»—–…。、"
SCRIPTS = [regex.compile(rf"\p{{{s}}}") for s in ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Hangul", "Han", "Hiragana", "Katakana", "Thai")]


@lru_cache(maxsize=None)
def _byte_of(code: str) -> dict[str, int]:
    """Characters of a single-byte code; undefined bytes as control codes."""
    out: dict[str, int] = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(code)] = b
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    return out


@lru_cache(maxsize=None)
def _lost_bytes(code: str) -> tuple[int, ...]:
    """The bytes a replacement character may stand for under a code."""
    out = []
    for b in range(128, 256):
        try:
            bytes([b]).decode(code)
        except UnicodeDecodeError:
            out.append(b)
    return tuple(out) or (0x81, 0x8D, 0x8F, 0x90, 0x9D)


@lru_cache(maxsize=100_000)
def _cost(c: str) -> float | None:
    """How unlikely a character is in right text; None rules it out."""
    o = ord(c)
    if 0xC0 <= o <= 0x17F and o not in (0xD7, 0xF7):
        return 0.0
    if 0x410 <= o <= 0x44F or o in (0x401, 0x451) or 0x3041 <= o <= 0x30FE or 0x2010 <= o <= 0x2026 or 0x3001 <= o <= 0x3011:
        return 0.0
    if 0x4E00 <= o <= 0x9FFF or 0xAC00 <= o <= 0xD7A3 or 0xFF01 <= o <= 0xFF9F:
        return 0.3
    if 0xA0 <= o <= 0xBF or o in (0xD7, 0xF7):
        return 0.5
    if 0x370 <= o <= 0x3FF or 0x400 <= o <= 0x491 or 0x5D0 <= o <= 0x5EA or 0x620 <= o <= 0x669 or 0x900 <= o <= 0x97F or 0xE01 <= o <= 0xE5B:
        return 0.6
    if 0x2030 <= o <= 0x203A or 0x2070 <= o <= 0x209C or 0x20A0 <= o <= 0x20BF or 0x2100 <= o <= 0x22FF or 0x2500 <= o <= 0x27BF or 0x1F300 <= o <= 0x1FAFF or 0x300 <= o <= 0x36F or 0x1D62 <= o <= 0x1D6A or o in (0x200B, 0x200D, 0xFE0F, 0xFEFF, 0x218, 0x219, 0x21A, 0x21B):
        return 0.8
    return None


def lattice_read(word: str, code: str, beam: int = BEAM) -> list[tuple[float, str, int, int]]:
    """The ``beam`` best readings of a word as UTF-8 seen through ``code``.

    Costs add up along a path, so keeping the best of each column keeps the
    best of all. Each is (cost, text, decoded characters, bytes guessed). The lattice has
    one column per character: its byte under the code, any lost byte for a
    replacement character, or the character itself where it is no part of a
    sequence.
    """
    known, lost = _byte_of(code), _lost_bytes(code)
    n = len(word)
    column = [(known[c],) if c in known else lost if c == LOST else () for c in word]
    best: list[list[tuple[float, str, int, int]]] = [[] for _ in range(n + 1)]
    best[0] = [(0.0, "", 0, 0)]
    for i in range(n):
        if not best[i]:
            continue
        here = sorted(best[i])[:beam]
        steps: list[tuple[int, float, str, int, int]] = []
        c = word[i]
        if c < "\x80":
            steps.append((1, 0.0, c, 0, 0))
        else:
            steps.append((1, 0.8 if c in TYPOGRAPHIC else 3.0, c, 0, 0))
            for lead in column[i]:
                size = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0
                if not size:
                    continue
                if i + size > n:
                    if i + 1 == n and lead == 0xC3:  # "à" whose blank was split off
                        steps.append((1, 2.5, "à", 1, 1))
                    continue
                tails = [[bytes([lead])]]
                for j in range(i + 1, i + size):
                    options = [b for b in column[j] if 0x80 <= b <= 0xBF]
                    if not options:
                        tails = []
                        break
                    tails = [[t + bytes([b]) for t in tails[0] for b in options]]
                wild = sum(word[j] == LOST for j in range(i, i + size))
                for raw in tails[0] if tails else []:
                    try:
                        got = raw.decode("utf-8")
                    except UnicodeDecodeError:
                        continue
                    cost = _cost(got) if got >= "\xa0" else 0.9 if got >= "\x80" else None
                    if cost is not None:
                        steps.append((size, cost + 0.4 * wild, got, 1, wild))
        for cost, text, done, guessed in here:
            for size, more, got, d, w in steps:
                best[i + size].append((cost + more, text + got, done + d, guessed + w))
    return [r for r in sorted(best[n])[:beam] if r[2]]


@lru_cache(maxsize=None)
def _sequence(code: str) -> regex.Pattern:
    """Where a UTF-8 sequence may begin under a code; elsewhere there is none to read."""
    known = _byte_of(code)
    of = lambda lo, hi: "".join(regex.escape(c) for c, b in known.items() if lo <= b <= hi) + LOST
    return regex.compile(f"[{of(0xC2, 0xF4)}](?:[{of(0x80, 0xBF)}]|\\Z)")


def natural(word: str) -> bool:
    """Whether a word looks like a word of one script with usual case."""
    return bool(NATURAL.fullmatch(word)) and sum(bool(s.search(word)) for s in SCRIPTS) <= 1


@lru_cache(maxsize=None)
def _legacy_codes() -> dict[str, tuple[frozenset, dict[int, str], list[str]]]:
    """Code seen -> its characters, their bytes as characters, the true codes."""
    out = {}
    for seen in dict(LEGACY):
        known = _byte_of(seen)
        out[seen] = (frozenset(known), {ord(c): chr(b) for c, b in known.items()}, [t for s, t in LEGACY if s == seen])
    return out


def _through(word: str) -> Iterator[tuple[str, str, str]]:
    """(seen, true, text) of a word under every pair of legacy codes."""
    wide = {c for c in word if c > "\x7f"}
    for seen, (known, table, trues) in _legacy_codes().items():
        if wide <= known:
            raw = word.translate(table).encode("latin-1")
            for true in trues:
                try:
                    yield seen, true, raw.decode(true)
                except UnicodeDecodeError:
                    continue


def _wide(word: str, code: str) -> tuple[str, int, int] | None:
    """UTF-8 seen through a multi-byte code, tolerating lost bytes."""
    raw = bytearray()
    for c in word:
        try:
            raw += c.encode(code)
        except UnicodeEncodeError:
            raw += b"\x81" if c == LOST else b"\x00"
    got = raw.decode("utf-8", "replace")
    wide = sum(c > "\x7f" and c != LOST and _cost(c) is not None for c in got)
    bad = got.count(LOST) + got.count("\x00")
    if wide >= 2 and wide >= 2 * bad and (KANA.search(got) or not bad):
        return got, wide, bad
    return None


def _weigh(got: str, done: int, cost: float, guessed: int) -> tuple[float, int, bool]:
    """Evidence of a reading, characters it keeps beyond those it decodes, whether it decodes all."""
    beyond = [c for c in got if c > "\x7f"]
    wide = sum(1 if c < "\u0800" else 2 if c < "\U00010000" else 3 for c in beyond)
    kept = sum(c not in TYPOGRAPHIC for c in beyond) - done
    return 2.0 * min(done, 4) + 0.5 * min(wide, 8) - min(cost, 4.0) - 0.3 * min(guessed, 5), kept, sum(c > "\x9f" for c in beyond) == done


def readings(word: str) -> list[tuple[str, str, float, bool, bool]]:
    """(channel, reading, structural evidence, needs frequencies, clear) of a word, likelier ones first.

    A clear reading is garbled by its structure alone, however rare its words.
    """
    out: dict[tuple[str, str], tuple[str, str, float, bool, bool]] = {}
    plain = natural(word)

    def add(channel: str, text: str, evidence: float, needs: bool, whole: bool = False) -> None:
        if text != word and ((channel, text) not in out or out[channel, text][2] < evidence):
            clear = not needs and channel.startswith("utf-8") and evidence > (1.5 if whole else 2.4)
            out[channel, text] = (channel, text, evidence, needs, clear)

    def utf8(text: str, prefix: str, base: float, depth: int) -> None:
        wide_signs = {c for c in text if c > "\x7f"}
        known: dict[tuple, list] = {}
        further: dict[str, tuple[float, str]] = {}
        for code in SEEN_AS:
            if not _sequence(code).search(text):
                continue
            # codes that have the same bytes for these characters read alike
            table = _byte_of(code)
            alike = (*(table.get(c, -1) for c in wide_signs), _lost_bytes(code) if LOST in wide_signs else ())
            if alike not in known:
                # four readings, the unread word aside; those beyond leave whole sequences unread, unless bytes are lost
                found = lattice_read(text, code, BEAM if LOST in wide_signs else 5)[: BEAM if LOST in wide_signs else 4]
                known[alike] = [(done, guessed, got, *_weigh(got, done, cost, guessed)) for cost, got, done, guessed in found]
            for done, guessed, got, gain, kept, whole in known[alike]:
                evidence = base + gain
                if evidence > 0 and kept <= done:
                    # natural words and few, guessed bytes need the corpus's support
                    add(prefix + code, got, evidence, plain and (done < 4 or not KANA.search(got)), whole)
                    if depth and not guessed and evidence > further.get(got, (0.0, ""))[0] and not got.isascii():
                        further[got] = (evidence, prefix + code + "+")
        for got, (evidence, through) in further.items():
            utf8(got, through, evidence, depth - 1)

    utf8(word, "utf-8>", 0.0, 2)
    if len(word) >= 2 and max(word) > "⺀":
        for code in SEEN_AS_WIDE:
            if hit := _wide(word, code):
                got, wide, bad = hit
                add("utf-8>" + code, got, 2.0 * min(wide, 5) - 1.5 * bad, plain or wide < 3)
    if len(word) >= 2 and LOST not in word and max(word) < "⺀":
        for seen, true, got in _through(word):
            if got != word and not DENSE.fullmatch(got) and all(c < "\x80" or _cost(c) is not None for c in got) and sum(c.isalpha() for c in got) >= 0.6 * len(got):
                add(f"{true}>{seen}", got, 0.0, True)
    return list(out.values())


def line_channel(line: str) -> str | None:
    """The wide legacy code a line was written in, if kana say so."""
    words = [w for w in WORD.findall(line) if not w.isascii()]
    if not words or KANA.search(line) or 2 * sum(map(natural, words)) > len(words):
        return None
    for seen, true in WIDE_LEGACY:
        table = _byte_of(seen)
        raw = bytearray()
        for c in line:
            if c in table:
                raw.append(table[c])
            elif c < "\x80":
                raw.append(ord(c))
            else:
                raw += b"?"
        got = raw.decode(true, "replace")
        kana = len(KANA.findall(got))
        if kana >= 4 and kana > 0.2 * sum(c > "\x7f" for c in got) and got.count(LOST) * 8 <= len(got):
            return f"{true}>{seen}"
    return None


SUSPECT_LINE = r"(?:[\x{0080}-\x{00ff}\x{0152}-\x{0192}\x{02c6}-\x{02dc}\x{03a9}-\x{03c0}\x{2013}-\x{2122}\x{2202}-\x{2265}\x{2500}-\x{25a0}\x{0400}-\x{045f}][\x{0000}-\x{007f}]?){6}"
LOST_IN_WORD = r"\p{L}\x{fffd}|\x{fffd}\p{L}"


#: a word with characters beyond ASCII; ASCII words are passed over at once
WIDE_WORD = JAVA_WORD.removesuffix("+").replace("[A-Za-z", "[", 1)
WIDE_WORD = rf"(?<![A-Za-z])[A-Za-z]*+{WIDE_WORD}{JAVA_WORD.removesuffix('+')}*+"


def wide_words(docs: DataFrame) -> DataFrame:
    """doc_id, digest and the distinct words with non-ASCII characters of each text."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(WIDE_WORD), 0))
    return docs.where(F.col("text").rlike(r"[^\x00-\x7f]")).select("doc_id", F.md5("text").alias("digest"), words.alias("words"))


def _corpus_words(texts: DataFrame) -> DataFrame:
    """(word, n, documents): its distinct texts, and its documents with few copies of each.

    Copies are reduced before the shuffle, so a text of a third of all rows
    counts, and costs, once a task.
    """
    once = texts.where(F.size("words") > 0).groupBy("digest").agg(F.first("words").alias("words"), F.count(F.lit(1)).alias("copies"))
    return once.select(F.explode("words").alias("word"), "copies").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum(F.least("copies", F.lit(COPIES))).alias("documents"))


def garbled_words(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """word, plain, options of each garbled word of the corpus.

    Options are its supported readings with channel and score, the best of each
    channel. Those worse than the word's best by more than two of the dearest
    changes of channel are in no best path of ``decide`` and are left out.
    A garbled word counts by its distinct texts, so no copies outweigh the
    documents with the right word.
    """
    # written once: the words are read as garbled and looked up as readings
    counts = materialize(_corpus_words(wide_words(docs) if texts is None else texts), "words")
    # a fixed number of tasks: words are few bytes but costly to read
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * docs.sparkSession.sparkContext.defaultParallelism)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                plain = natural(word)
                rows += [(word, n, ch, got, ev, needs, clear, plain, -i) for i, (ch, got, ev, needs, clear) in enumerate(readings(word))]
            cols = list(zip(*rows)) or [[]] * 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.float64()), pa.array(cols[5], pa.bool_()), pa.array(cols[6], pa.bool_()), pa.array(cols[7], pa.bool_()), pa.array(cols[8], pa.int32())],
                ["word", "n", "channel", "reading", "evidence", "needs", "clear", "plain", "place"],
            )

    read_as = counts.select("word", "n").repartition(tasks).mapInArrow(read, "word string, n bigint, channel string, reading string, evidence double, needs boolean, clear boolean, plain boolean, place int")
    known = counts.select(F.col("word").alias("reading"), F.col("documents").alias("m"))
    scored = read_as.join(known, "reading", "left").withColumn("m", F.coalesce("m", F.lit(0)))
    # a reading made of ASCII only is no word of this count; it rests on its evidence
    gain = F.log((F.col("m") + 0.5) / (F.col("n") + 0.5))
    legacy = ~F.col("channel").startswith("utf-8")
    # what is garbled by its structure is found however common it is: the right
    # words' frequencies choose among its readings only
    chosen = F.col("evidence") + F.when(F.col("clear"), F.log(2 * F.col("m") + 1)).otherwise(gain)
    score = F.when(legacy, gain + F.when(F.col("plain"), -0.5).otherwise(0.5)).otherwise(chosen)
    supported = F.when(legacy, (F.col("m") >= 3) & (F.col("m") >= 3 * F.col("n"))).when(F.col("needs"), (F.col("m") >= 2) & (F.col("m") >= 3 * F.col("n"))).otherwise(F.lit(True))
    kept = scored.where(supported).withColumn("score", score).where(F.col("score") > F.when(legacy, 0.4).otherwise(1.5))
    found = kept.select("word", "reading", "channel", "score", "m", "plain", "place").unionByName(_lost_words(counts))
    best = (
        found.repartition("word")
        .groupBy("word", "channel")
        .agg(F.max(F.struct("score", "m", "place", "reading")).alias("b"), F.max("plain").alias("plain"))
        .groupBy("word")
        .agg(F.max("plain").alias("plain"), F.max("b.score").alias("top"), F.sort_array(F.collect_list(F.struct("b.score", "b.m", "b.reading", "channel")), asc=False).alias("options"))
    )
    return materialize(best.select("word", "plain", F.filter("options", lambda o: o["score"] >= F.col("top") - 2 * PLAIN_CHANGE).alias("options")), "garbled")


def _lost_words(counts: DataFrame) -> DataFrame:
    """Words with replacement characters and the commonest word around them.

    Both sides are keyed by the word with every non-ASCII character masked.
    """
    masked = F.regexp_replace("word", r"[^\x00-\x7f]", LOST)
    lost = counts.where(F.col("word").contains(LOST) & F.col("word").rlike("[A-Za-z].*[A-Za-z]")).withColumn("mask", masked)
    whole = counts.where(~F.col("word").contains(LOST)).select(masked.alias("mask"), F.col("word").alias("reading"), F.col("documents").alias("m"))
    fits = lost.join(whole, "mask").groupBy("word", "n").agg(F.max(F.struct("m", "reading")).alias("b")).where("b.m >= 2")
    return fits.select("word", "b.reading", F.lit(LOST_CHANNEL).alias("channel"), F.log((F.col("b.m") + 0.5) / (F.col("n") + 0.5)).alias("score"), "b.m", F.lit(False).alias("plain"), F.lit(0).alias("place"))


def cited(text: str, word: str, reading: str) -> bool:
    """Every occurrence of the word stands in a line with its right form."""
    at = text.find(word)
    while at >= 0:
        lo, hi = text.rfind("\n", 0, at) + 1, text.find("\n", at)
        line = text[max(lo, at - 48 - len(reading)) : min(len(text) if hi < 0 else hi, at + len(word) + 48 + len(reading))]
        if not regex.search(rf"(?<![\p{{L}}\p{{N}}]){regex.escape(reading)}(?![\p{{L}}\p{{N}}])", line.replace(word, " ")):
            return False
        at = text.find(word, at + len(word))
    return True


def lost_cited(text: str, at: int, end: int) -> bool:
    """Whether the right form of the word with lost characters stands beside it."""
    lo, hi = text.rfind("\n", 0, at) + 1, text.find("\n", end)
    line = text[max(lo, at - 64) : at] + "\n" + text[end : min(len(text) if hi < 0 else hi, end + 64)]
    return bool(regex.search(r"\p{L}{1,2}".join(map(regex.escape, text[at:end].split(LOST))), line))


Options = dict[str, list[tuple[str, str, float]]]


def _spans(text: str, words: Options, lines: bool) -> list[tuple[int, int, str, list[tuple[str, str, float]], bool]]:
    """What a path may read: (start, end, text, options, is a line) of words and whole lines, lines first."""
    out, at = [], 0
    for line in text.split("\n") if lines else ():
        if channel := line_channel(line):
            got = read_line(line, channel)
            # each kana is a letter that the line hardly has by chance
            out.append((at, at + len(line), line, [(got, channel, 0.5 * len(KANA.findall(got)))], True))
        at += len(line) + 1
    for m in WORD.finditer(text):
        options = words.get(m[0], [])
        if LOST in m[0] and any(map(str.isalpha, m[0])) and not lost_cited(text, m.start(), m.end()):
            options = [(got, ch, max(s, LOST_ODDS)) for got, ch, s in options] or [(m[0], LOST_CHANNEL, LOST_ODDS)]
        if options:
            out.append((m.start(), m.end(), m[0], options, False))
    return sorted(out, key=lambda x: (x[0], not x[4]))


def change(before: str, after: str, plain: bool) -> float:
    """What it costs to go from one channel to another between two words."""
    if before == after:
        return 0.0
    if not after or after.startswith("utf-8"):
        return CHANGE
    if before.split(">")[0] == after.split(">")[0]:
        return 0.0  # the same code, seen through two
    return PLAIN_CHANGE if plain else LEGACY_CHANGE


def decide(text: str, words: Options, plain: frozenset | set = frozenset(), lines: bool = False) -> list[tuple[int, int, str, str, str]]:
    """(start, end, word, channel, reading) along the best path of a document.

    Viterbi: states are the channels in force; "" leaves a word as it is and
    emits 0. ``words`` holds (reading, channel, score) of garbled words, the
    ``plain`` ones of which look right; other words say nothing of the channel.
    A word's score counts where it first stands. Of equal paths the first wins.
    """
    paths: dict[str, tuple[float, tuple | None]] = {"": (0.0, None)}
    seen: set[str] = set()
    over: tuple[int, dict] | None = None

    def extended(span: tuple, fresh: bool, keep: bool) -> dict[str, tuple[float, tuple | None]]:
        a, b, w, options, _ = span
        step: dict[str, tuple[float, tuple | None]] = {}
        for got, ch, s in [*([(w, "", 0.0)] if keep else []), *options]:
            score, path = max(((x - change(before, ch, w in plain), p) for before, (x, p) in paths.items()), key=lambda x: x[0])
            score += s if fresh else 0.0
            if ch not in step or score > step[ch][0]:
                step[ch] = (score, (path, (a, b, w, ch, got)))
        return step

    def better(one: dict, other: dict) -> dict:
        return {ch: max((x[ch] for x in (one, other) if ch in x), key=lambda y: y[0]) for ch in {**one, **other}}

    for span in _spans(text, words, lines):
        if over and span[0] >= over[0]:
            # a line read as a whole, or word by word
            paths, over = better(paths, over[1]), None
        if span[4]:
            over = (span[1], extended(span, True, False))
            continue
        paths = extended(span, span[2] not in seen, True)
        seen.add(span[2])
    if over:
        paths = better(paths, over[1])
    chain, out = max(paths.values(), key=lambda x: x[0])[1], []
    while chain:
        chain, got = chain
        out.append(got)
    return out[::-1]


def restore(text: str, words: Options, plain: frozenset | set = frozenset(), lines: bool = False) -> tuple[bool, str]:
    """Whether the best path reads anything but the text itself, and what."""
    out, at, garbled = [], 0, False
    for a, b, _, ch, got in decide(text, words, plain, lines):
        out += [text[at:a], got]
        at, garbled = b, garbled or bool(ch)
    return garbled, "".join(out) + text[at:]


def read_line(line: str, channel: str) -> str:
    """A line written in a wide legacy code, read in that code."""
    true, seen = channel.split(">")
    table = _byte_of(seen)
    return b"".join(bytes([table[c]]) if c in table else c.encode() if c < "\x80" else b"?" for c in line).decode(true, "replace")


def find_garbled(docs: DataFrame) -> DataFrame:
    """doc_id and restored_text of the garbled documents of ``docs``.

    ``docs`` has doc_id (unique) and text; other columns are ignored. A word
    whose bytes are lost stays as it is in restored_text.
    """
    docs = docs.where("text is not null").select("doc_id", "text")
    # each text is parsed once: for the corpus's counts and for its own words
    texts = materialize(wide_words(docs), "texts")
    words = garbled_words(docs, texts)
    hits = texts.select("doc_id", F.explode("words").alias("word")).join(words, "word").groupBy("doc_id").agg(F.collect_list(F.struct("word", "plain", "options")).alias("hits"))
    odd = docs.where(F.col("text").rlike(r"[^\x00-\x7f]")).select("doc_id", "text", F.col("text").rlike(LOST_IN_WORD).alias("lost"), F.col("text").rlike(SUSPECT_LINE).alias("suspect"))
    rows = odd.join(hits, "doc_id", "left").where("hits is not null or lost or suspect")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = [], []
            for doc, text, suspect, found in zip(*(c.to_pylist() for c in b.columns)):
                by = {h["word"]: [(o["reading"], o["channel"], o["score"]) for o in h["options"]] for h in found or []}
                plain = {h["word"] for h in found or [] if h["plain"]}
                by = {w: options for w, options in by.items() if not any(cited(text, w, got) for got in {o[0] for o in options})}
                garbled, right = restore(text, by, plain, suspect)
                if garbled:
                    ids.append(doc)
                    texts.append(right)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(texts, pa.string())], ["doc_id", "restored_text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "suspect", "hits").mapInArrow(judge, f"doc_id {kind}, restored_text string")
