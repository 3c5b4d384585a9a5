"""Refusals in wordings that were written after the grammar, and texts near them."""

import time

import pytest

from dialoom.llm import language
from dialoom.llm import pair_defects as d

# 48 wordings, six a language; not to be used for the lexicons.
HELD_OUT = """I don't feel comfortable discussing this.|I must refuse to provide this.|This falls outside of what I'm allowed to cover, so I'll pass.|We are not in a position to comment on the matter.|Sorry, giving advice on that would go against my rules.|That's a topic I will not touch.
Dazu möchte ich mich nicht äußern.|Ich bin nicht befugt, darüber zu reden.|Leider muss ich es ablehnen, dazu etwas zu sagen.|Das geht gegen meine Richtlinien.|Auf solche Fragen werde ich nicht eingehen.|Hier kann ich nicht behilflich sein.
Je regrette, mais je ne souhaite pas aborder cette question.|Je ne vais pas vous fournir ces informations.|Désolé, je dois décliner.|Cela va à l'encontre de mes règles.|Je ne peux pas en parler.|Je m'abstiens de répondre.
Me niego a contestar a eso.|Lo siento, no me es posible ayudar.|No voy a hablar de ese asunto.|Eso queda fuera de mis normas.|Me temo que no puedo ofrecer esa información.|Debo declinar la solicitud.
Recuso-me a falar sobre isso.|Não vou responder a essa questão.|Isso vai contra as minhas diretrizes.|Lamento, não consigo ajudar com esse pedido.|Não me é possível fornecer isso.|Devo recusar a solicitação.
Nie chcę się na ten temat wypowiadać.|Nie mogę udzielić takich informacji.|To wykracza poza moje zasady.|Odmawiam odpowiedzi.|Niestety nie jestem upoważniony, by o tym mówić.|Nie będę tego komentować.
Я не хочу это обсуждать.|К сожалению, не могу предоставить такую информацию.|Это противоречит моим правилам.|Вынужден отказаться от ответа.|Мы не готовы комментировать это.|На это я не буду отвечать.
その点については回答を控えさせていただきます。|申し訳ございませんが、ご案内できません。|その依頼には応じられません。|この件はお断りいたします。|それについては説明できかねます。|私からは何もお伝えできません。""".split("\n")
SOUND = [
    "You can't answer this without a key.",
    "The rules do not let players talk.",
    "We do not offer this in March.",
    "During the second pass we check every row again.",
    "I'm sorry for the delay, but the tray opens if you press the button.",
    "I can't say for sure. The second row may help: it lists every tray.",
    "Ich kann dir nicht nur helfen, sondern auch zeigen, wie es geht.",
    "Das Fach darf nicht offen sein.",
    "Vous ne pouvez pas répondre sans clé.",
    "No puedo creer lo que pasó en la oficina.",
    "Nie wolno otwierać szuflady.",
    "Нельзя открывать лоток во время печати.",
    "線路の点検が続いているからです。",
]


def test_recall_on_held_out_wordings():
    found = [[d.is_refusal(x) for x in line.split("|")] for line in HELD_OUT]
    missed = [x for line, hits in zip(HELD_OUT, found) for x, hit in zip(line.split("|"), hits) if not hit]
    recall = sum(map(sum, found)) / sum(map(len, found))
    print("recall", round(recall, 3), missed)
    assert recall >= 0.9


@pytest.mark.parametrize("text", SOUND)
def test_sound_answers(text):
    assert not d.is_refusal(text)


@pytest.mark.parametrize(
    "text,lang",
    [
        ("이 서랍을 열고 종이를 꺼내세요.", "ko"),
        ("请打开抽屉，把纸拿出来，然后重新启动打印机等待一分钟。请再试一次吧。", "zh"),
        ("Deschideți sertarul și scoateți hârtia, iar dacă nu este goală, încercați din nou cu un alt document.", "ro"),
        ("Open de lade en haal het papier eruit, maar wacht een minuut voor je de printer weer aanzet.", "nl"),
        ("افتح الدرج وأخرج الورق ثم انتظر دقيقة.", "ar"),
    ],
)
def test_languages_beyond_the_eight(text, lang):
    assert language.main_language(text) == lang
    assert d.defect("What should I do when the printer refuses every page?", text, None) == "other_language"


def test_long_misread_pair_is_aligned_in_time():
    words = [f"w{i % 977}x{i % 89}" for i in range(40_000)]
    began = time.time()
    assert d.defect(" ".join(words), " ".join(w.replace("7", "1") if i % 3 else w for i, w in enumerate(words)) + ".", None) == "copies_prompt"
    assert time.time() - began < 10


def test_letters_between_anchors():
    p, r = d.tokens("the old tray opens when the new sensor reads paper"), d.tokens("the old trai openz when the new sensor raeds paper")
    assert d.letters_lcs(p, r) == d.lcs("".join(p), "".join(r)) and d.letters_lcs(p, p) == len("".join(p)) and d.letters_lcs(p, []) == 0
