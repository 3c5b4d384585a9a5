"""Which language a stretch of text is written in.

Function words, letters and elisions of eight languages vote; scripts decide
where they can, those of languages beyond the eight too. A Latin text that
none of the eight explains is tried with the function words of further
languages. Code, links, numbers, identifiers and quotations don't count.
"""

from __future__ import annotations

import re
from collections import Counter

import regex

# Common function words.
WORDS = {
    "en": "the a an and or of to in on is are was were be been it its this that these those with for from by as at not no but if then than so what which who how why when where can could should would will may do does did have has had i you he she we they my your his her our their me them there here only any some all every one two very more most about into over after before between because while whether also just please yes let us see true never once week way write tell explain describe compare help sure",
    "de": "der die das den dem des ein eine einen einem einer und oder aber nicht kein keine ist sind war waren wird werden hat haben mit für von zu zum zur im in am an auf aus bei nach vor über unter durch ohne um wenn dass ob wie was wer warum weil als auch nur noch schon sehr ich du er sie es wir ihr mich mir dich dir uns sich mein dein sein alle alles jede jeder jedes dieser diese dieses man so es zwischen seit während beim bitte ja nein hier sind punkte schritte gilt zwei paar ganze schreibe schreib erkläre bitte tipps",
    "fr": "le la les un une des du de et ou mais ne pas plus est sont était dans sur sous avec pour par sans chez que qui quoi dont où comment pourquoi quand si ce cet cette ces il elle on nous vous ils elles je tu me te se mon ma mes ton ta tes son sa ses notre votre leur au aux en y aussi très tout toute tous toutes deux avant après pendant puis ensuite donc bref ainsi entre même oui non voici faut peux à près dès chaque écris écrivez explique expliquer idées propos",
    "es": "el la los las un una unos unas y o pero no sí es son era está están en de del al con por para sin sobre entre hasta desde que quien qué cómo cuándo dónde cuál si se su sus mi mis tu tus lo le les me te nos yo tú él ella ellos este esta estos estas ese esa eso esto muy más también además antes después cuando porque ya cada todo toda todos todas dos aquí hay ser fue pan año según escribe escriba explica explícame consejos",
    "pt": "o a os as um uma uns umas e ou mas não sim é são era está estão em no na nos nas de do da dos das ao à aos às com por pelo pela para sem sobre entre até desde que quem como quando onde qual se seu sua seus suas meu minha eu tu ele ela eles nós você isto isso este esta esse essa muito mais também além antes depois porque já cada todo toda todos todas duas dois aqui há ser foi então porém escreva explique explica sugestões diga",
    "pl": "i oraz albo lub ale nie tak jest są był była było w we na do z ze od za po pod nad przed przy przez o u dla bez między że żeby który która które co kto jak kiedy gdzie dlaczego czy jeśli gdy to ta ten te tego tej tym się jej jego ich mój moja twój ja ty on ona my wy oni mi mnie bardzo też także tylko już jeszcze więc każdy każda dwa trzy oto jednak poza następnie potem zawsze prawie napisz wyjaśnij porównaj porad wskazówek podaj",
}
# Function words of further languages, for texts that none of the above explains.
FURTHER = {
    "it": "il lo la gli le un una di del della dei delle e o ma non che chi è sono era con per da dal dalla nel nella su sul come quando perché se anche più questo questa suo sua loro ci si mi ti molto ogni tra",
    "nl": "de het een en of maar niet geen is zijn was waren wordt met voor van op in aan bij uit naar over onder door om te dat die deze dit wat wie hoe waar als ook nog wel ik je hij zij wij jullie hun haar er",
    "ro": "și sau dar nu este sunt era cu pentru din la pe în de un o care ce cine cum unde când dacă mai foarte acest această lui ei lor noi voi eu tu el ea se să a al ale despre după",
    "sv": "och eller men inte är var med för av på i till från om som att det den en ett de vi ni jag du han hon hur när där också mycket detta denna sin sitt ska kan har",
    "da": "og eller men ikke er var med for af på i til fra om som at det den en et de vi jeg du han hun hvordan når hvor også meget denne dette sin skal kan har",
    "cs": "a nebo ale není je jsou byl byla s pro z na v do od o který která co kdo jak kde když jestli také více velmi tento tato jeho její jejich my vy já ty se si že by",
    "tr": "ve veya ama değil bir bu şu o ile için gibi da de ne kim nasıl nerede zaman eğer çok daha en ben sen biz siz onlar var yok olarak olan ki mi",
    "hu": "és vagy de nem van volt a az egy hogy mint ha is csak már még ez azt ki mi hol hogyan mikor mert nagyon én te ő mi ti ők meg el",
    "id": "dan atau tetapi tidak adalah yang di ke dari untuk dengan pada ini itu saya anda kami mereka dia akan sudah bisa jika juga lebih sangat seperti oleh",
    "vi": "và hoặc nhưng không là của cho với từ trong trên này đó tôi bạn chúng họ nếu cũng rất như được có một những các",
    "fi": "ja tai mutta ei on oli ovat joka mikä kuka miten missä kun jos myös hyvin tämä se ne minä sinä hän me te he että kuin sekä",
}
FURTHER_VOTES: dict[str, list[str]] = {}
for _lang, _words in FURTHER.items():
    for _word in set(_words.split()):
        FURTHER_VOTES.setdefault(_word, []).append(_lang)
# Scripts that tell a language, or a group of them.
SCRIPTS = {"ko": "[\uac00-\ud7a3\u1100-\u11ff]", "ar": "[\u0600-\u06ff]", "he": "[\u0590-\u05ff]", "el": "[\u0370-\u03ff]", "hi": "[\u0900-\u097f]", "th": "[\u0e00-\u0e7f]"}
SCRIPT = {lang: re.compile(letters) for lang, letters in SCRIPTS.items()}
SHARED = Counter(w for words in WORDS.values() for w in set(words.split()))
#: word -> the languages it votes for and the weight of each vote
VOTES: dict[str, tuple[float, list[str]]] = {w: (1.5 / n, [lang for lang, words in WORDS.items() if w in words.split()]) for w, n in SHARED.items()}
# Letters that point to a language, and how strongly.
LETTERS = {
    "de": {"ß": 3.0, "ä": 1.5, "ö": 1.0, "ü": 1.0},
    "fr": {"œ": 3.0, "è": 1.2, "ê": 0.7, "ù": 2.0, "û": 1.0, "î": 1.5, "ë": 1.0, "ç": 0.5, "é": 0.5, "à": 0.4, "â": 0.5},
    "es": {"ñ": 3.0, "¿": 3.0, "¡": 3.0, "ó": 0.4, "í": 0.5, "á": 0.4, "é": 0.3, "ú": 0.5},
    "pt": {"ã": 3.0, "õ": 3.0, "ç": 0.6, "ê": 0.5, "ô": 1.2, "â": 0.5, "á": 0.3, "ú": 0.3, "í": 0.3, "à": 0.3, "ó": 0.2, "é": 0.2},
    "pl": {"ł": 3.0, "ż": 3.0, "ź": 3.0, "ś": 2.5, "ć": 2.5, "ń": 2.5, "ą": 3.0, "ę": 3.0, "ó": 0.4},
}
#: letter -> (language, weight) pairs
LETTER_VOTES: dict[str, list[tuple[str, float]]] = {}
for _lang, _letters in LETTERS.items():
    for _letter, _weight in _letters.items():
        LETTER_VOTES.setdefault(_letter, []).append((_lang, _weight))
LETTER = re.compile(f"[{''.join(LETTER_VOTES)}]")
KANA = re.compile("[\u3041-\u30ff]")
HAN = re.compile("[\u3400-\u9fff]")
CYRILLIC = re.compile("[\u0400-\u04ff]")
#: a word; letters beside digits or underscores belong to an identifier
WORD = re.compile(r"(?<!\w)[^\W\d_]+(?!\w)")
#: the same with identifiers, which no list has
ANY_WORD = re.compile(r"\w+")
ELISION = re.compile(r"(?<!\w)(?:l|d|qu|n|s|c|j|m|t)[’'](?=[^\W\d_]{2})")
ENGLISH_SHORT = re.compile(r"[^\W\d_](?:n[’']t|[’'](?:s|re|ve|ll|d|m))(?!\w)")
ASIDE = regex.compile(
    r"```.*?(?:```|\Z)|`[^`\n]*`|https?://\S+|^[ \t]*>.*$|^[ \t]*\|.*$|^[ \t]*[{\[].*[}\]\":,][ \t]*$|“[^”]*”|„[^“”]*[“”]|«[^»]*»|「[^」]*」|\"[^\"\n]*\"|\[\[[^\]]*\]\]|\([^()\n]{0,60}\)|[@#]\S+",
    regex.S | regex.M,
)


#: Without one of these there is nothing aside.
ASIDE_SIGN = re.compile("[`>|{}\\[“„«「\"(@#]|://")


def plain(text: str) -> str:
    """The text without code, links, quotations, tables and identifiers."""
    return ASIDE.sub(" ", text) if ASIDE_SIGN.search(text) else text


def scores(text: str) -> dict[str, float]:
    """Evidence for each language in a text already made plain."""
    out: dict[str, float] = {}
    high = max(text, default="")
    if high >= "\u0370":
        han = len(HAN.findall(text)) if high >= "\u3041" else 0
        if kana := len(KANA.findall(text)):
            out["ja"] = 1.5 * kana + han
        elif han:
            out["zh"] = 1.0 * han
        if cyr := len(CYRILLIC.findall(text)):
            out["ru"] = 1.0 * cyr
        for lang, letters in SCRIPT.items():
            if n := len(letters.findall(text)):
                out[lang] = 1.0 * n
    low = text.lower()
    for w, n in Counter(ANY_WORD.findall(low)).items():
        if (vote := VOTES.get(w)) is not None:
            for lang in vote[1]:
                out[lang] = out.get(lang, 0.0) + n * vote[0]
    if high >= "\x80":
        for c, n in Counter(LETTER.findall(low)).items():
            for lang, weight in LETTER_VOTES[c]:
                out[lang] = out.get(lang, 0.0) + n * weight
    if "'" in low or "’" in low:
        if n := len(ELISION.findall(low)):
            out["fr"] = out.get("fr", 0.0) + 1.5 * n
        if n := len(ENGLISH_SHORT.findall(low)):
            out["en"] = out.get("en", 0.0) + 1.0 * n
    return out


#: Evidence a word that a text of function words and others has at least.
THIN = 0.3


def _further(text: str, best: float) -> str | None:
    """A further language whose function words make up the text, if any.

    At least three words and a quarter of them, and half as many again as any of
    the eight languages has evidence for.
    """
    words = WORD.findall(text.lower())
    votes = Counter(lang for w in words for lang in FURTHER_VOTES.get(w, ()))
    ranked = votes.most_common(2)
    if not ranked or ranked[0][1] < max(3, 0.25 * len(words)) or ranked[0][1] <= 1.5 * best:
        return None
    return ranked[0][0] if len(ranked) < 2 or ranked[0][1] > ranked[1][1] else None


def detect(text: str, least: float = 1.4, margin: float = 1.25) -> str | None:
    """The language of a plain text, or None where the evidence is thin."""
    by = scores(text)
    best = max(by.values(), default=0.0)
    ranked = [x for x, n in by.items() if margin * n > best]
    decided = ranked[0] if best >= least and len(ranked) == 1 else None
    if decided is None or best < THIN * (text.count(" ") + 1):
        return _further(text, best) or decided
    return decided


def clearly(text: str, lang: str, by: dict[str, float] | None = None) -> bool:
    """Whether a plain text as a whole speaks for ``lang`` beyond doubt.

    All other languages together have less than a sixth of its evidence, which
    leaves them no half of the text.
    """
    by = scores(text) if by is None else by
    mine = by.get(lang, 0.0)
    return mine >= max(4.0, THIN * (text.count(" ") + 1)) and 6 * (sum(by.values()) - mine) < mine


SENTENCE = re.compile(r"(?<=[.!?。！？…;:])\s+|(?<=[。！？])|\n+")


def shares(text: str, is_plain: bool = False) -> dict[str, int]:
    """Letters of the text's sentences by language; undecided ones left out."""
    out: Counter[str] = Counter()
    for s in SENTENCE.split(text if is_plain else plain(text)):
        if s and (lang := detect(s)):
            # a letter of a script that writes whole words weighs more
            out[lang] += sum(map(str.isalpha, s)) * (3 if lang in ("ja", "zh", "ko") else 1)
    # lines in Han alone belong to the Japanese around them
    if out["ja"]:
        out["ja"] += out.pop("zh", 0)
    elif out["zh"] < 24:
        out.pop("zh", 0)
    return {lang: n for lang, n in out.items() if n}


def main_language(text: str, is_plain: bool = False) -> str | None:
    """The language of most of the text; for texts of one thin sentence, of all."""
    text = text if is_plain else plain(text)
    by = scores(text)
    if by and clearly(text, top := max(by, key=by.__getitem__), by):
        return top
    if by := shares(text, True):
        lang = max(sorted(by), key=by.__getitem__)
        if 2 * by[lang] > sum(by.values()):
            return lang
        return None
    return detect(text, 0.9)
