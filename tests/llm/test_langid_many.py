"""Every labelled language is told apart, however many there are and however rare."""

import random

from ledgerlake.llm import langid


def test_more_languages_than_sixty_four(spark):
    dice = random.Random(2)
    names = [a + b for a in "abcdefghi" for b in "klmnopqrs"]  # 81
    words = {name: ["".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for name in names}

    def text(name):
        return " ".join(dice.choice(words[name]) for _ in range(30))

    labelled = [(text(names[0]), names[0]) for _ in range(1500)] + [(text(name), name) for name in names[1:] for _ in range(4)]
    frame = spark.createDataFrame(labelled, "text string, lang string")
    model = langid.train(frame, "text", "lang", sample=60)
    assert sorted(model.languages) == sorted(names)
    pages = [(i, f"https://site{i}.example/", f"<html lang='{name}'><body>{text(name)}</body></html>") for i, name in enumerate(names)]
    shown = langid.pages_evidence(spark.createDataFrame(pages, "page_id long, url string, html string"), "page_id", "url", "html",
                                  model.languages)
    found = {row.id: row for row in langid.identify(shown, model).collect()}
    assert [found[i].lang for i in range(len(names))] == names
    assert [found[i].text_lang for i in range(len(names))] == names
    assert [found[i].declared for i in range(len(names))] == names
