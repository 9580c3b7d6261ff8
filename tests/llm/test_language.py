from __future__ import annotations

import random
import zlib

import pytest

from panelloom.llm import language, registry
from panelloom.llm.registry import table

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string, margin string, n int"
SYLLABLES = {"aa": ["ka", "mo", "ti", "ru", "sel"], "bb": ["sch", "eng", "ung", "lich", "ber"], "cc": ["eau", "oux", "ion", "ment", "que"]}


def text_of(lang, seed, n=40):
    rnd = random.Random(f"{lang}{seed}")
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randrange(1, 5))) for _ in range(n))


def make(spark, rows):
    return spark.createDataFrame([(i, t, y, "x", "y", 1) for i, t, y in rows], SCHEMA)


def training(spark):
    rows = [(i, text_of(lang, i), lang) for i in range(60) for lang in SYLLABLES]
    return make(spark, rows + [(1, None, "aa"), (2, "text", None), (None, "text", "cc"), (3, "", "bb")])


def test_languages_are_told(spark):
    model = language.fit(training(spark))
    rows = [(100 + i, text_of(lang, 1000 + i).upper() + "! 12", lang) for i in range(20) for lang in SYLLABLES]
    judged = language.identify(make(spark, rows), model)
    assert judged.columns == ["doc_id", "text", "lang", "n", "lang_pred", "score", "margin", "rejected"]
    for r in judged.collect():
        assert r.lang_pred == r.lang and 0 < r.score <= 1 and not r.rejected


def test_odd_texts(spark):
    model = language.fit(training(spark))
    long = text_of("bb", 1, 200_000)
    rows = [(1, None, "aa"), (2, "", "aa"), (3, " 12 ?! ", "aa"), (4, long, "aa"), (5, "日本", "aa"), (5, "日本", "aa"), (None, long, None)]
    got = [(r.lang_pred, r.score, r.rejected) for r in language.identify(make(spark, rows), model).collect()]
    assert [g[0] for g in got[:4]] == ["und", "und", "und", "bb"] and got[6][0] == "bb"
    assert all(g[1] == 0 and g[2] for g in got[:3]) and got[4] == got[5] and got[4][0] in SYLLABLES


def test_empty_tables(spark):
    none = make(spark, [])
    assert language.fit(none) == []
    assert language.identify(none, language.fit(training(spark))).collect() == []
    r = language.identify(make(spark, [(1, "some text", "aa")]), []).first()
    assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)


def test_the_fit_is_bounded(spark):
    model = language.fit(training(spark), per_language=10)
    assert all(len(d) < 60 * language.PIECE for _, parts in model for d in parts)


def test_held_out_accuracy(spark):
    got = registry.QUERIES["op8_compression_language_id"](spark, SF_DIR)
    truth = table(spark, SF_DIR, "documents").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held_out) >= 0.97 * len(held_out)


def test_a_language_of_few_documents_fills_its_dictionaries(spark):
    rows = [(i, text_of(lang, i, 300), lang) for lang, n in (("aa", 400), ("bb", 400), ("cc", 8)) for i in range(n)]
    held = {name: sum(map(len, parts)) for name, parts in language.fit(make(spark, rows), per_language=400)}
    many = sum(len(language.plain(t)) for _, t, y in rows if y == "cc")
    assert held["cc"] > 0.8 * min(many, held["aa"]) and max(held.values()) < 400 * (language.PIECE + 1) * 1.3
    all_of_it = dict(language.fit(make(spark, rows[-3:]), per_language=400))["cc"]
    assert 0.95 * sum(len(t) for _, t, _ in rows[-3:]) < sum(map(len, all_of_it))


def test_languages_never_learned_are_rejected(spark):
    judge = language.Judge(language.fit(training(spark)))
    rnd = random.Random(4)
    letters = ["".join(rnd.choice("bdfghjpqvwxyz    ") for _ in range(n)) for n in (200, 500, 1000, 2000, 5000) for _ in range(20)]
    narrow = [judge.judge(t) for t in letters]
    assert sum(r[3] for r in narrow) >= 0.8 * len(narrow) > sum(r[2] == 0 for r in narrow)
    assert not any(judge.judge(text_of(lang, 2000 + n, n))[3] for lang in SYLLABLES for n in (20, 40, 400, 4000, 20_000))


def test_sizes_again_by_plain_compression(spark):
    """Language, margin and rejection of every text from sizes by zstandard alone, over the fitted dictionaries."""
    import zstandard

    model = language.fit(training(spark))
    rows = [(k, text_of(lang, 3_000 + k, n), lang) for k, (lang, n) in enumerate((lang, n) for lang in SYLLABLES for n in (1, 2, 3, 8, 40, 400))]
    rows += [(90, "ka schenux 12", "aa"), (91, "x", "bb")]

    def size(content, data):
        if len(content) < 8:
            return len(zstandard.ZstdCompressor(level=language.LEVEL, write_content_size=False).compress(data))
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False).compress(data))

    for r in language.identify(make(spark, rows), model).collect():
        data = language.plain(r.text)
        first = [size(parts[0], data) for _, parts in model]
        asked = 1
        if sorted(first)[1] - min(first) < language.CLOSE:
            first, asked = [sum(size(c, data) for c in parts) for _, parts in model], language.DICTIONARIES
        best, second = sorted(first)[:2]
        assert (r.lang_pred, r.margin) == (model[first.index(best)][0], second - best)
        assert r.rejected == (1000 * (second - best) < language.REJECT * min(best, language.SATURATED * asked))


def test_more_languages_than_a_model_holds_raise(spark):
    rows = spark.range(language.MOST_LANGUAGES + 1).selectExpr("id as doc_id", "'some text' as text", "concat('l', id) as lang")
    with pytest.raises(ValueError, match="different values of lang"):
        language.fit(rows)
    assert len(language.fit(rows.limit(3))) == 3
