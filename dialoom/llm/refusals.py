"""Refusals by grammar: sentences aligned with templates of word classes.

A sentence becomes the sequence of the classes its words belong to; templates
are short sequences of classes (someone speaking of themselves, a negation, a
modal, an act of answering, a word of declining, a limit). The longest common
subsequence aligns the two, so any words may stand between: a template fits if
all of it is aligned. Wordings need not be known; lexicons are per language,
and a language is chosen by the sentence itself, the one with a fit.

Defined results: an empty sentence is no refusal; a sentence that goes on after
a word like "but" is one only up to that word, and so none; of over ``LONGEST``
words none is.
"""

from __future__ import annotations

from collections.abc import Callable

#: Words of a sentence that can do no more than refuse.
LONGEST = 26
# Words and phrases by class. S self, X negation, M modal, A act of
# answering, D decline, L limit, O outside, C contrast, G what limits belong to.
LEXICON = {
    "en": {
        "S": "i|we|me|us|my|mine|our",
        "X": "not|t|never|no|nothing|without",
        "M": "can|could|will|would|won|able|ability|allowed|permitted|authorized|authorised|willing|comfortable|position|going|may|should|must|do|don|does|doesn|let|want|wish|intend|free|prepared|supposed|meant|designed|set up",
        "XM": "cannot|unable|unwilling|impossible|rather not|prefer not|hesitate|uncomfortable|forbidden|prohibited|barred|restricted from|prevented from|refrain from",
        "A": "help|helping|assist|assisting|answer|answers|answering|respond|responding|reply|discuss|discussing|talk|talking|speak|speaking|provide|providing|share|sharing|give|giving|comply|complying|fulfill|fulfil|produce|generate|cover|offer help|offer advice|offer assistance|offer information|offer guidance|offer an answer|offer any|support|address|engage|comment|advise|advice|tell|do that|do this|do it|go into|get into|go there|take part|be of help|handle|entertain|work on|take on|touch|weigh in|assistance|information|guidance",
        "D": "decline|declining|refuse|refusing|ll pass|will pass|must pass|have to pass|need to pass|pass on|respectfully pass|abstain|turn down|turn this down|turn that down|aside|say no|sit this one out|opt out|skip this|skip that|stay away|steer clear|draw the line|leave it there|leave this one",
        "O": "outside|beyond|against|off limits|falls under|goes against|violate|violates|out of bounds|conflicts with|contrary to|not within|not part of",
        "L": "guidelines|policies|policy|rules|scope|allowed|permitted|boundaries|limits|remit|terms|principles|restrictions",
        "C": "but|however|although|though|instead|nevertheless|still",
        "": "not only|not just|no doubt|no matter|my help|t help but",
    },
    "de": {
        "S": "ich|wir|mir|mich|uns|meine|meiner|meinen",
        "X": "nicht|keine|kein|keinen|keinerlei|nie|niemals|nichts|ungern",
        "M": "kann|darf|möchte|will|werde|können|dürfen|möchten|könnte|lage|imstande|erlaubt|gestattet|bereit|befugt|soll|gebe|gibt|geben",
        "XM": "außerstande|unmöglich|untersagt|verboten|verwehrt",
        "A": "helfen|weiterhelfen|behilflich|unterstützen|beantworten|antworten|antwort|auskunft|auskünfte|sprechen|reden|besprechen|diskutieren|äußern|nachkommen|entsprechen|liefern|bereitstellen|erstellen|eingehen|sagen|mitteilen|dienen|hilfe|informationen|erfüllen|bearbeiten|behandeln",
        "D": "ablehnen|lehne|verweigern|verweigere|verzichten|absehen|passen|ausklammern|beiseite",
        "O": "außerhalb|gegen|verstößt|übersteigt",
        "L": "richtlinien|regeln|vorgaben|rahmens|grenzen|darf|möglichkeiten|grundsätze|bestimmungen",
        "C": "aber|jedoch|allerdings|dennoch|stattdessen|sondern",
        "": "nicht nur|keine frage",
    },
    "fr": {
        "S": "je|j|nous|me|m|moi|mes|mon|ma",
        "X": "ne|n|pas|jamais|aucune|aucun|rien|plus",
        "M": "peux|pouvons|pourrai|puis|saurais|vais|veux|souhaite|mesure|autorisé|autorisée|permis|possible|droit|capable|suis|permettent|permet|donnerai|donne|dois|préfère",
        "XM": "impossible|incapable|interdit|préfère ne pas|regret de ne pouvoir",
        "A": "aider|répondre|réponse|traiter|parler|discuter|aborder|fournir|donner|partager|satisfaire|accéder|assister|produire|commenter|évoquer|traite|parle|aide|informations|exprimer|entrer",
        "D": "refuser|refuse|décliner|décline|abstenir|abstiens|écarter",
        "O": "hors|contraire|contre|dépasse|sort|va à l encontre",
        "L": "règles|consignes|directives|principes|cadre|limites|permis|autorisé|politique|conditions",
        "C": "mais|cependant|toutefois|néanmoins|pourtant",
        "": "pas seulement|pas seulement|rien que",
    },
    "es": {
        "S": "yo|me|mi|mis|nosotros|nuestras|nuestros",
        "X": "no|nunca|ninguna|ningún|nada|tampoco",
        "SM": "puedo|podemos|podré|quiero|voy a|debo|estoy|soy|tengo|prefiero|doy|daré|deseo",
        "M": "permitido|autorizado|autorizada|posible|capaz|condiciones|permiten|permite|dispuesto",
        "SXM": "me es imposible|me resulta imposible|prefiero no|me niego",
        "A": "ayudar|ayudarte|ayudarle|responder|responderte|respuesta|respuestas|contestar|hablar|tratar|discutir|dar|ofrecer|proporcionar|compartir|cumplir|atender|asistir|comentar|opinar|facilitar|abordar|entrar|información|ayuda",
        "SD": "debo rechazar|tengo que rechazar|rechazo|declino|debo declinar|tengo que declinar|tengo que negarme|debo negarme|debo abstenerme|me abstengo|paso de",
        "O": "fuera|contra|más allá|excede|incumple",
        "L": "normas|reglas|directrices|políticas|alcance|límites|permitido|principios",
        "C": "pero|sin embargo|aunque|no obstante|sino",
        "": "no solo|no sólo|no solamente",
    },
    "pt": {
        "S": "eu|me|mim|meu|minha|minhas|meus|nós|nossas|nossos",
        "X": "não|nunca|nenhuma|nenhum|nada|sem",
        "SM": "posso|podemos|poderei|quero|vou|devo|estou|sou|tenho|prefiro|dou|darei|consigo",
        "M": "permitido|permissão|autorizado|autorizada|possível|capaz|permitem|permite|condições",
        "SXM": "é me impossível|prefiro não|recuso me|me recuso",
        "A": "ajudar|ajudá|responder|resposta|respostas|falar|tratar|discutir|dar|oferecer|fornecer|compartilhar|partilhar|cumprir|atender|comentar|opinar|abordar|entrar|informação|informações|ajuda|auxiliar",
        "SD": "preciso recusar|tenho de recusar|tenho que recusar|devo recusar|recuso|declino|preciso declinar|tenho de declinar|devo declinar|abstenho|vou passar",
        "O": "fora|contra|além|ultrapassa|viola",
        "L": "regras|normas|diretrizes|políticas|âmbito|limites|permitido|princípios",
        "C": "mas|porém|contudo|no entanto|entretanto|todavia",
        "": "não só|não apenas|não somente",
    },
    "pl": {
        "S": "ja|mi|mnie|moje|moich|nasze",
        "X": "nie|nigdy|żadnych|żadnej|nic",
        "SM": "mogę|możemy|będę|chcę|zamierzam|jestem|wolę|udzielam|udzielę|potrafię|powinienem|powinnam|mam",
        "M": "wolno|stanie|upoważniony|upoważniona|możliwe|pozwalają|pozwala|można",
        "SXM": "nie jestem w stanie|nie wolno mi|wolę nie",
        "A": "pomóc|pomagać|odpowiedzieć|odpowiadać|odpowiedzi|mówić|rozmawiać|poruszać|omawiać|udzielić|udzielać|udzielam|podać|podawać|spełnić|komentować|wypowiadać|dostarczyć|pomocy|informacji",
        "SD": "muszę odmówić|odmawiam|muszę zrezygnować|muszę uchylić|spasuję|pominę",
        "O": "poza|wbrew|wykracza|sprzeczne|narusza",
        "L": "zasady|zasadami|wytyczne|wytycznymi|zakres|granice|reguły|regulamin",
        "C": "ale|jednak|natomiast|lecz|jednakże",
        "": "nie tylko",
    },
    "ru": {
        "S": "я|мне|мы|нам|мои|моим|меня",
        "X": "не|ни|никаких|никакой|нельзя|невозможно|нет",
        "M": "могу|можем|смогу|буду|хочу|вправе|состоянии|разрешено|позволено|готов|готова|даю|дам|позволяют|имею",
        "SXM": "мне нельзя|я не вправе|вынужден воздержаться",
        "A": "помочь|помогать|ответить|отвечать|ответов|ответа|говорить|обсуждать|обсудить|рассказать|рассказывать|предоставить|дать|давать|выполнить|комментировать|поделиться|помощи|информации|содействовать|касаться",
        "D": "отклонить|отказать|отказаться|отказываюсь|отказываю|отклоняю|воздержусь|воздержаться|промолчу",
        "O": "выходит|вне|против|противоречит|нарушает|за пределами",
        "L": "правила|правил|правилам|рамки|пределы|политика|ограничения|инструкции|полномочий",
        "C": "но|однако|зато|хотя|впрочем",
        "": "не только",
    },
    "ja": {
        "A": "答え|回答|返答|手伝い|手助け|対応|話し|話す|説明|提供|お力|協力|応じ|触れ|コメント|案内",
        "X": "できません|できない|できかね|いたしかね|しかね|致しかね|なれません|ません|おりません|控え|遠慮|差し控え",
        "D": "お断り|辞退|拒否|見送ら",
        "C": "ですが、|しかし|ただし|けれど",
    },
}
# Sequences of classes that refuse.
TEMPLATES = ("SMXA", "SXMA", "MSXA", "XSMA", "AMSX", "ASMX", "AXSM", "SAXM", "SAMX", "XMSA", "SD", "OL", "OSM", "SLXMA", "LXMSA")
JAPANESE = ("AX", "D")


def _phrases(tokens: Callable[[str], list[str]]) -> dict[str, dict[str, list[tuple[tuple[str, ...], str]]]]:
    """Language -> first token -> (tokens, classes) of its phrases, longest first."""
    out: dict[str, dict[str, list[tuple[tuple[str, ...], str]]]] = {}
    for lang, classes in LEXICON.items():
        at = out[lang] = {}
        for labels, phrases in classes.items():
            for phrase in phrases.split("|"):
                words = tuple(tokens(phrase))
                at.setdefault(words[0], []).append((words, labels))
        for found in at.values():
            found.sort(key=lambda x: -len(x[0]))
    return out


class Grammar:
    """Refusals of all lexicons over the tokens of ``tokens``."""

    def __init__(self, tokens: Callable[[str], list[str]], lcs: Callable[[list[str], list[str]], int]):
        self.lcs, self.phrases = lcs, _phrases(tokens)
        # every template has one of these classes: without its words there is no fit
        self.signs = {lang: frozenset(w for w, found in at.items() if any(set("XDO") & set(labels) for _, labels in found)) for lang, at in self.phrases.items()}

    def classes(self, words: list[str], lang: str) -> str:
        """The classes of the sentence's words, in order; phrases win over words."""
        at, out, i = self.phrases[lang], [], 0
        while i < len(words):
            for phrase, labels in at.get(words[i], ()):
                if tuple(words[i : i + len(phrase)]) == phrase:
                    out.append(labels)
                    i += len(phrase)
                    break
            else:
                i += 1
        return "".join(out)

    def refuses(self, words: list[str]) -> bool:
        """Whether a sentence's words are those of a refusal."""
        if not words or len(words) > LONGEST * (3 if words[0] > "　" else 1):
            return False
        for lang in self.phrases:
            if not self.signs[lang].isdisjoint(words) and self._fits(self.classes(words, lang), lang):
                return True
        return False

    def _fits(self, found: str, lang: str) -> bool:
        for template in JAPANESE if lang == "ja" else TEMPLATES:
            if len(found) < len(template) or self.lcs(template, found) < len(template):
                continue
            # the shortest beginning that holds the template; what comes after may not contradict it
            at = 0
            for c in template:
                at = found.index(c, at) + 1
            if "C" not in found[at:]:
                return True
        return False
