import random

import pytest
from pyspark.sql import functions as F

from portolan.llm import language_id

from .helpers import awkward_rows, documents

WORDS = {"en": "the and of with that this have from they would there their which about".split(),
         "de": "der die und nicht für über schön müssen können werden einen zwischen straße".split(),
         "fr": "le la être avec pour dans où très déjà même français garçon élève mais".split()}


def text_in(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, text_in(rng, lang, 60), lang, "s", 1) for i, lang in enumerate(list(WORDS) * 40)]
    return language_id.fit(documents(spark, rows))


def test_held_out_accuracy(spark, model):
    rng = random.Random(2)
    rows = [(i, text_in(rng, lang, 25), lang, "s", 1) for i, lang in enumerate(list(WORDS) * 30)]
    got = language_id.identify(documents(spark, rows), model, ["doc_id"]).collect()
    truth = {r[0]: r[2] for r in rows}
    assert sum(r.lang == truth[r.doc_id] for r in got) >= 0.98 * len(rows)
    assert all(0 < r.probability <= 1 for r in got)


def test_unknown_text(spark, model):
    texts = ["", None, "12 34 -- ::", "Привет мир это другой язык", "日本語のテキスト", "qxzj wvkq zzxq qqwx jxkz vqxj"]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = language_id.identify(documents(spark, rows), model, ["doc_id"], declared=F.col("lang")).collect()
    assert {r.lang for r in got} == {"und"}


def test_evidence_decides_short_texts(spark, model):
    rng = random.Random(3)
    rows = [(i, text_in(rng, "de", 30), "de", "haus.de", 1) for i in range(60)]
    rows += [(100 + i, text_in(rng, "fr", 30), "fr", "maison.fr", 1) for i in range(60)]
    rows += [(200, "la die", "de", "haus.de", 1), (201, "la die", "fr", "maison.fr", 1)]
    parts = F.split("source", r"\.")
    got = {r.doc_id: r for r in language_id.identify(
        documents(spark, rows), model, ["doc_id"], declared=F.col("lang"), suffix=F.element_at(parts, -1),
        host=F.col("source"), domain=F.col("source")).collect()}
    assert (got[200].lang, got[201].lang) == ("de", "fr") and got[200].text_lang == got[201].text_lang


def test_posterior_by_hand(spark, model):
    rows = [(i, t, "en", "h", 1) for i, t in enumerate(["the and of", "der und die", "le la être", "the die"])]
    got = {r.doc_id: r for r in language_id.identify(documents(spark, rows), model, ["doc_id"], declared=F.col("lang"),
                                                     host=F.col("source"), domain=F.col("source")).collect()}
    import math

    names = [*model.languages, "und"]
    logs = {}
    for i, t, *_ in rows:
        s = model.score(t)
        n = min(s[-1], language_id.EFFECTIVE)
        logs[i] = [*(x * n for x in s[:-1]), -21 * math.log(2) * n]
    best = {i: max(range(4), key=lambda k: v[k]) for i, v in logs.items()}
    counts = [sum(b == k for b in best.values()) for k in range(4)]
    whole = [(c + 1) / (len(rows) + 4) for c in counts]
    domain = [(c + 8 * p) / (4 + 8) for c, p in zip(counts, whole)]
    host = [(c + 8 * p) / (4 + 8) for c, p in zip(counts, domain)]
    for i, v in logs.items():
        total = [x + math.log(h) + math.log((c + 0.5) / (c + 2.0)) for x, h, c in zip(v, host, counts)]
        k = max(range(4), key=lambda j: total[j])
        assert got[i].lang == names[k]
        assert got[i].probability == pytest.approx(1 / sum(math.exp(x - total[k]) for x in total))


def test_awkward_rows_and_clashing_columns(spark, model):
    rows = awkward_rows()
    docs = documents(spark, rows, extra=True)
    got = language_id.identify(docs, model, ["doc_id"], declared=F.col("lang"), host=F.col("source"))
    assert got.count() == len(rows)
    kept = language_id.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert {200, 201, 202}.isdisjoint({r.doc_id for r in kept.collect()})
    assert language_id.keep_known(documents(spark, []), model).collect() == []


def test_nothing_to_learn_from(spark):
    none = language_id.fit(documents(spark, []))
    rows = [(1, "the and", "en", "s", 1)]
    assert [r.lang for r in language_id.identify(documents(spark, rows), none, ["doc_id"]).collect()] == ["und"]


def test_queries(spark, tmp_path):
    from portolan.llm.registry import QUERIES

    rng = random.Random(5)
    rows = [(i, text_in(rng, lang, 60), lang, f"{lang}.org" if i % 2 else "src0", 1) for i, lang in enumerate(list(WORDS) * 30)]
    rows += [(500, "12 34", "en", "src0", 1), (501, None, None, None, None)]
    documents(spark, rows, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    pages = [(i, f"https://www.site.{lang}/{i}", f'<html lang="{lang}"><p>{text_in(rng, lang, 40)}</p></html>')
             for i, lang in enumerate(list(WORDS) * 5)] + [(90, None, None), (None, "x", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    docs = {r.doc_id: r.lang for r in QUERIES["op8_language_id"](spark, str(tmp_path)).collect()}
    assert docs == {r[0]: r[2] if r[0] < 500 else "und" for r in rows}
    got = {r.page_id: (r.lang, r.declared, r.suffix) for r in QUERIES["page_language_id"](spark, str(tmp_path)).collect()}
    assert got == {**{i: (lang, lang, lang) for i, lang in enumerate(list(WORDS) * 5)}, 90: ("und", None, None), None: ("und", None, None)}


def test_address_and_markup(spark):
    df = spark.createDataFrame([("https://u:p@Blog.A.example.com:80/x?y", "<html><!-- a > b --><style>p{}</style><p>Hi&amp;you</p>"),
                                ("no address", None), (None, "")], "url string, html string")
    got = df.select(language_id.host_of(F.col("url")).alias("h"), language_id.page_text(F.col("html")).alias("t")).collect()
    assert [r.h for r in got] == ["blog.a.example.com", None, None]
    assert got[0].t.split() == ["Hi", "you"] and got[1].t is None


def test_rare_labels_are_classes_at_any_size(spark):
    rng = random.Random(6)
    rows = [(i, text_in(rng, "en", 20), "en", "s", 1) for i in range(4000)]
    rows += [(9000 + i, text_in(rng, "de", 60), "de", "s", 1) for i in range(12)] + [(9500, text_in(rng, "fr", 60), "fr", "s", 1)]
    docs = documents(spark, rows)
    whole, drawn = language_id.fit(docs), language_id.fit(docs, sample_rows=20)
    assert whole.languages == drawn.languages == ["de", "en", "fr"]
    new = [(i, text_in(rng, lang, 25), None, "s", 1) for i, lang in enumerate(list(WORDS) * 10)]
    for model in (whole, drawn):
        got = language_id.identify(documents(spark, new), model, ["doc_id"]).collect()
        assert {r.doc_id: r.text_lang for r in got} == {i: list(WORDS)[i % 3] for i in range(30)}
    # The rarer label's rows are all in, whatever the other one's rate; a rate never rounds to nothing.
    alone = language_id.fit(docs.where("lang = 'de'"))
    text = text_in(rng, "de", 40)
    assert drawn.score(text)[0] == pytest.approx(alone.score(text)[0])
    assert language_id.fit(docs, sample_rows=1).languages == ["de", "en", "fr"]


def test_unseen_trigrams_cost_the_same_in_samples_of_any_size(spark):
    rng = random.Random(7)
    rows = [(i, text_in(rng, "en", 400), "en", "s", 1) for i in range(200)] + [(900, text_in(rng, "de", 60), "de", "s", 1)]
    model = language_id.fit(documents(spark, rows))
    de, en, _ = model.score("qxzj wvkq zzxq")
    assert de == pytest.approx(en)


OTHER = {"ru": "что это как так его только было если когда время можно после".split(),
         "uk": "що це як так його тільки було якщо коли час можна після їх є".split(),
         "ar": "في من على هذا الذي كان إلى التي عن مع كل بعد".split(),
         "fa": "در از این است که را با برای آن یک می چه گفت".split(),
         "hi": "है और में की यह नहीं के लिए कर पर हैं था".split(),
         "mr": "आहे आणि मध्ये ची हे नाही च्या साठी करून वर आहेत होता".split(),
         "ja": ["日本語", "の", "に", "これは", "です", "東京", "ました", "という", "人"],
         "zh": ["中文", "的", "这是", "我们", "北京", "没有", "他们", "说", "人"],
         "vi": "của và là không được một người những với để trong tiếng".split()}


def test_languages_that_share_other_scripts(spark):
    rng = random.Random(9)

    def text(lang, n):
        return ("" if lang in ("ja", "zh") else " ").join(rng.choice(OTHER[lang]) for _ in range(n))

    model = language_id.fit(documents(spark, [(i, text(lang, 40), lang, "s", 1) for i, lang in enumerate(list(OTHER) * 20)]))
    new = {i: lang for i, lang in enumerate(list(OTHER) * 10)}
    got = language_id.identify(documents(spark, [(i, text(lang, 15), None, "s", 1) for i, lang in new.items()]), model, ["doc_id"])
    assert {r.doc_id: r.text_lang for r in got.collect()} == new


def test_other_scripts_are_unknown_where_one_is_labelled(spark):
    rng = random.Random(10)
    model = language_id.fit(documents(spark, [(i, " ".join(rng.choices(OTHER["ru"], k=40)), "ru", "s", 1) for i in range(30)]))
    rows = [(i, " ".join(rng.choices(OTHER[lang], k=30)), "ru", "s", 1) for i, lang in enumerate(["ar", "hi", "ja", "zh", "vi"])]
    got = language_id.identify(documents(spark, rows), model, ["doc_id"]).collect()
    assert {r.text_lang for r in got} == {"und"}


def test_trigrams_of_letters():
    def same(a, b):
        return language_id.trigrams(a).tolist() == language_id.trigrams(b).tolist()

    assert same("ÉCOLE", "e\u0301cole") and same("ΑΒΓ", "αβγ") and same("a--b", "a b")
    assert not same("ạ", "ả") and not same("қ", "ҡ") and not same("ɓa", "ɗa") and not same("कि", "की")
    assert [len(language_id.trigrams(t)) for t in ("", "12 34 \u0301", "ab", "人人", "☀\ufe0f")] == [0, 0, 2, 2, 0]


def test_labels_count_by_their_language(spark):
    texts = {"en": "the cat and the dog went over the hill", "fr": "le chat et le chien sur la colline"}
    rows = [(i, texts[x], tag, "s", 1) for x, tags in (("en", ["en", "EN", " en-US", "en_GB"]), ("fr", ["fr", "FR-ca", "fr", "Fr"]))
            for i, tag in enumerate(tags)]
    rows += [(90, texts["en"], " ", "s", 1), (91, texts["en"], None, "s", 1)]
    assert language_id.fit(documents(spark, rows)).languages == ["en", "fr"]


def test_too_many_labels_are_an_error(spark):
    rows = [(i, f"some words {i}", f"l{i}", "s", 1) for i in range(language_id.MOST_CLASSES + 1)]
    with pytest.raises(ValueError, match="401 labels"):
        language_id.fit(documents(spark, rows))
