"""The quality rules' edges: junk that is common, alone in its band, or short."""

import random

import pytest

from lakeloom.llm import quality
from test_models import PIECES

WORDS = "the of and to in a that was he for it with as his on be at by had not are but from or have an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years where much your way down should because long each just state people those too little good very make world still see own work men day get here old life both between being under three never know same last another while us might great year come since against go right came take used himself few house use during without again place around however home small found thought went say part once general high upon school every".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def garbled(seed, n):
    """Words of letters that no language puts together: two letters a token."""
    r = random.Random(seed)
    return " ".join("".join(r.choice("bcdfghjklmnpqrstvwxzaeiou") for _ in range(r.randint(4, 9))) for _ in range(n))


def kept_of(rows, docs_of):
    got = quality.judge(docs_of(rows), PIECES).collect()
    assert len(got) == len(rows)
    return {r.doc_id for r in got if r.kept}


@pytest.mark.parametrize("lang", ["en", None])
def test_a_third_of_junk_does_not_move_the_edges(docs_of, lang):
    good = [(i, prose(i, 70 + i % 12), lang) for i in range(200)]
    junk = [(1000 + i, garbled(i, 70 + i % 12), lang) for i in range(100)]
    assert kept_of(good + junk, docs_of) == {r[0] for r in good}


def test_copies_of_a_junk_text_do_not_move_the_edges(docs_of):
    good = [(i, prose(i, 70 + i % 12), "en") for i in range(150)]
    junk = [(1000 + i, garbled(0, 75), "en") for i in range(400)]
    assert kept_of(good + junk, docs_of) == {r[0] for r in good}


def test_a_band_of_one_is_judged_with_its_language_or_script(docs_of):
    good = [(i, prose(i, 70 + i % 12), "en") for i in range(150)] + [(200, prose(200, 400), "en"), (201, prose(201, 400), "nl"), (202, prose(202, 75), None)]
    junk = [(300, garbled(1, 2000), "en"), (301, garbled(2, 2000), "nl"), (302, garbled(3, 75), None), (303, garbled(4, 400), "xx")]
    assert kept_of(good + junk, docs_of) == {r[0] for r in good}


def test_texts_that_are_alone_meet_fixed_limits(docs_of):
    russian = "Комитет согласился что жатва начнётся до дождей и никто не покинет деревню пока работа не будет сделана"
    rows = [(1, russian, "ru"), (2, russian, None), (3, russian, "en"), (4, prose(1, 80), "en"), (5, prose(1, 80), "zh-TW"), (6, " ".join("☃☄★" + chr(0x2700 + i) for i in range(60)), "en")]
    assert kept_of(rows, docs_of) == {1, 2, 4}


def test_short_texts_are_judged(docs_of):
    good = [(i, prose(i, 60 + i % 40), "en") for i in range(150)] + [(400 + n, prose(n, n), "en") for n in range(10, 30)]
    junk = [(500 + n, garbled(n, n), "en") for n in range(10, 30)]
    assert kept_of(good + junk, docs_of) == {r[0] for r in good}
