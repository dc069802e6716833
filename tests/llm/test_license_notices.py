import random

import pytest

from airq.llm import license_scan

MIT, APACHE = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["Apache-2.0"]


def found(spark, texts):
    """(license, wording, number of differences) of every notice, per text and in its order."""
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    rows = sorted(license_scan.scan(df, "id", "body").collect(), key=lambda r: (r["key"], r["begin"]))
    for r in rows:
        assert texts[r["key"]][r["begin"]:r["begin"] + r["length"]] == r["block"]
    return [[(r["license"], r["block"], r["n_differences"]) for r in rows if r["key"] == k] for k in range(len(texts))]


def chatter(n, seed=1):
    """Sentences that hold a licensing word and no notice."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9)))
    return [f"{word()} {word()} license {word()} {word()} {word()}." for _ in range(n)]


def test_notice_in_a_long_block(spark, monkeypatch):
    texts = [" ".join(chatter(n)[:n // 2] + [MIT] + chatter(n)[n // 2:]) for n in (0, 20, 100, 2000)]
    texts.append(" ".join(chatter(100) + [t for k, t in license_scan.TEMPLATES.items() if k == "GPL-3.0"]))
    want = [[("MIT", MIT[:-1], 0)]] * 4 + [[("GPL-3.0", license_scan.TEMPLATES["GPL-3.0"][:-1], 0)]]
    assert found(spark, texts) == want
    known = license_scan.Templates(license_scan.TEMPLATES)
    whole = [known.notices(t, 0.8) for t in texts]
    for window in (1, 7, 64):  # a notice across the edge of a window is whole in another
        monkeypatch.setattr(license_scan, "WINDOW", window)
        assert [known.notices(t, 0.8) for t in texts[:3]] == whole[:3]


def test_every_notice_of_a_block(spark):
    t = license_scan.TEMPLATES
    texts = [f"{MIT} {APACHE}", f"{MIT}\n{MIT}\n{APACHE}\n{MIT}", f"Copyright (c) 2019 Someone. All rights reserved.\n{t['MIT-text']}",
             t["Apache-2.0-header"].replace("may not use", "must not use"), "\n".join(t.values())]
    got = found(spark, texts)
    assert [[name for name, *_ in x] for x in got] == [
        ["MIT", "Apache-2.0"], ["MIT", "MIT", "Apache-2.0", "MIT"], ["Copyright", "MIT-text"], ["Apache-2.0-header"], list(t)]
    assert [n for x in got for *_, n in x] == [0] * 8 + [1] + [0] * len(t)


@pytest.mark.parametrize("fill", ["2019 Acme Corp", "2019-2023 Acme", "2019-2023, The Regents of the University of California", "2001, 2004 Ann Example and Bob Example", "Acme"])
def test_fill_ins_of_several_words(spark, fill):
    text = f"Copyright (c) {fill}. All rights reserved"
    assert found(spark, [f"{text}.\n{MIT}", "Copyright. All rights reserved.", f"One. {text}. Two."]) == [
        [("Copyright", text, 0), ("MIT", MIT[:-1], 0)], [], [("Copyright", text, 0)]]


def test_differences_beside_fill_ins():
    known = license_scan.Templates(license_scan.TEMPLATES)
    (name, *_, share, notes), = known.notices("Copyright (c) 2019-2023 Acme Corp. All the rights reserved.", 0.8)
    assert (name, share, notes) == ("Copyright", 1.0, ["- +the"])
    (name, *_, share, notes), = known.notices("Copyright 2019-2023 Acme Corp. All rights reserved.", 0.8)
    assert (name, share, notes) == ("Copyright", 6 / 7, ["-c +"])
