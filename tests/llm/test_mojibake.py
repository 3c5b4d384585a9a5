import pytest

from dialoom.llm import mojibake as m

SOUND = [
    "Der Zähler prüft die übrigen Zeilen früh am Morgen. Das ältere Konto erklärt die Größe.",
    "La señal explica el año pasado después del cambio. ¿Cómo sé si el niño perdió la canción?",
    "L’élève répète la crème fraîche près du théâtre, déjà très général.",
    "Соседка пропускает найденные страницы. Первый ответ заменяет каждое вложение.",
    "Źródło wyjaśnia każdy załącznik. Sąsiadka gubi żółtą teczkę, a późny pociąg śledzi listę.",
    "夜行列車は青いファイルを比べます。検索の手順は短い質問を説明します。",
    "The café résumé is naïve – “quoted” and it’s fine at 30 °C (±0.5).",
] * 6


def garble(text, seen, true="utf-8", errors="strict"):
    """``text`` read in a wrong code; bytes it lacks become control codes."""
    raw = text.encode(true)
    if errors == "strict" and seen != "utf-8":
        return "".join(bytes([b]).decode(seen, "replace").replace("\ufffd", chr(b)) for b in raw)
    return raw.decode(seen, errors)


def found(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*SOUND, *texts])], "doc_id long, text string, word string")
    return {r["doc_id"] - len(SOUND): r["restored_text"] for r in m.find_garbled(df).collect()}


def test_garbled_and_sound(spark):
    right = [SOUND[0], SOUND[1], SOUND[2], SOUND[3], SOUND[5], SOUND[6]]
    texts = [
        garble(right[0], "latin-1"),
        garble(garble(right[1], "latin-1"), "latin-1"),
        garble(right[2], "mac_roman"),
        garble(right[3], "cp437"),
        garble(right[4], "latin-1"),
        garble(right[5], "cp1252"),
        garble(right[3], "cp1252", "cp1251"),
        garble(right[0], "utf-8", "latin-1", "replace"),
        "The word señal appears as " + garble("señal", "cp1252") + " in the list.",
        "| " + garble("café", "cp437") + " | café |",
        "The sequence `�` is what `señal` turns into.",
        "├── raw\n│   ├── a.json",
        "Σx ≤ 5, ملاحظة: الصفحة",
        "Most is sound, but the caf" + garble("é", "cp1252") + " is not.",
        None,
        "",
        "plain text",
    ]
    got = found(spark, texts)
    assert set(got) == {0, 1, 2, 3, 4, 5, 6, 7, 13}
    for i in (0, 1, 2, 3, 4, 5):
        assert got[i] == right[i]
    assert got[6] == right[3] and got[7] == right[0] and got[13] == "Most is sound, but the café is not."


def test_copies_and_rare_words(spark):
    copies = [garble(SOUND[3], "cp1252", "cp1251")] * 40
    rare = ["Only " + garble("Qvärnö", "cp1252") + f" is wrong, {i}." for i in range(30)] + ["At 30 " + garble("°C", "cp1252") + " it melts."] * 20
    got = found(spark, [*copies, *rare, "Я» и «В…» здесь"])
    assert set(got) == set(range(90))
    assert all(got[i] == SOUND[3] for i in range(40)) and all(got[i] == f"Only Qvärnö is wrong, {i - 40}." for i in range(40, 70))


def test_channels_compete_in_a_document(spark):
    """One word, two channels: its neighbours say which is in force."""
    words = {"x¤": [("xa", "mac_roman>cp1252", 1.5), ("xb", "cp437>cp1252", 1.4)], "y¤": [("yb", "cp437>cp1252", 1.4)], "z¤": [("za", "mac_roman>cp1252", 1.4)]}
    assert m.restore("x¤ sé y¤", words) == (True, "xb sé yb") and m.restore("x¤ sé z¤", words) == (True, "xa sé za")
    assert [c[3] for c in m.decide("x¤ y¤", words)] == ["cp437>cp1252"] * 2
    # one weak legacy word is none, however often it stands; a weak word of UTF-8 is one
    assert m.restore("x¤ and x¤ and x¤", words) == (False, "x¤ and x¤ and x¤")
    assert m.restore("é¤", {"é¤": [("ö", "utf-8>cp1252", 1.1)]}) == (True, "ö") and not m.restore("é¤", {"é¤": [("ö", "utf-8>cp1252", 0.9)]})[0]
    assert m.restore("a S�z b", {}) == (True, "a S�z b") and not m.restore("S�z is Satz", {})[0]
    # é and Ž share a byte: mac_roman has 0x8e as é, cp437 as Ä, both seen as Ž
    sound = ["Le pré est vert, le thé est bon"] * 4 + ["Das prÄ und das thÄ Öl, schön Öl"] * 5
    options = {r["word"]: {o["channel"]: o["reading"] for o in r["options"]} for r in m.garbled_words(spark.createDataFrame(list(enumerate([*sound, "Le prŽ vert"])), "doc_id long, text string")).collect()}
    assert {"pré", "prÄ"} <= set(options["prŽ"].values())


def test_lost_bytes():
    text = "Соседка"
    seen = "".join(bytes([b]).decode("cp1252", "replace") for b in text.encode())
    assert "�" in seen and m.lattice_read(seen, "cp1252")[0][1].lower()[1:2] == "о"
    assert any(r[1].lower() == "соседка" for r in m.lattice_read(seen, "cp1252"))


def test_natural():
    assert all(map(m.natural, ["Größe", "КОТ", "l’été", "señal"])) and not any(map(m.natural, ["GrÃ¶ÃŸe", "РґРІРµ", "caf├⌐"]))


def test_long_and_empty(spark):
    long = "ordinary words " * 50_000 + garble("Größe", "cp1252")
    assert set(found(spark, [long])) == {0}
    assert m.find_garbled(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("code", m.SEEN_AS)
def test_round_trip(code):
    for word in ("señal", "Größe", "мир", "łąka"):
        try:
            seen = word.encode().decode(code)
        except UnicodeDecodeError:
            continue
        assert word in [r[1] for r in m.readings(seen)]
