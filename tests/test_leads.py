from pyspark.sql import functions as F

from siftworks import rules
from siftworks.functions import classify, html, text
from siftworks.functions.domains import is_premium
from siftworks.operators import incremental, labelling, leads
from siftworks.plans import fixtures as fx


def one(spark, column, *values, kind="string"):
    names = [f"c{i}" for i in range(len(values))]
    return spark.createDataFrame([values], ", ".join(f"{n} {kind}" for n in names)).select(column(*map(F.col, names))).first()[0]


def test_sizes_of_the_rules():
    assert len(rules.DOMAIN_KEYWORDS) == 146 and len(rules.DOMAIN_SUFFIXES) == 17
    assert [len(w) for _, w in rules.BUSINESS] == [21, 18, 19, 19]
    assert [len(w) for _, w in rules.PRODUCT] == [18, 17, 19, 12, 16, 17, 13, 16, 15, 16, 12, 13, 12, 11]
    assert len(rules.STOP_WORDS) == 40 and len(rules.NICHES) == 11 and len(rules.LEADING_EMOJI) == 12


def test_premium_domains(spark):
    got = [r[0] for r in fx.frame(spark, fx.DOMAINS).where(is_premium(F.col("domain"))).collect()]
    assert sorted(got) == sorted(["glow.com", "GLOW.COM", "mailbox.xyz", "x123.com", "a" * 22 + ".com", " padded.io\t"])


def test_first_match_wins(spark):
    cases = {"add to cart and login": "💻 SaaS / Software", "capital gains": "💻 SaaS / Software", "shop now": "📦 Physical Product Brand", "we help founders": "🛠️ Service Based", "join the waitlist": "🚀 Startup", "": "❓ Unclear"}
    for words, label in cases.items():
        assert one(spark, classify.business_type, words) == label
    for words, label in {"education": "🐾 Pets", "steam engine": "🍔 Food & Beverage", "capital gains": rules.PRODUCT_ELSE}.items():
        assert one(spark, classify.product_category, words) == label


def test_content_words(spark):
    for domain, want in (("x.com", "glow Glow serum"), ("glow.com", "serum"), (None, "glow Glow serum")):
        assert one(spark, text.content_words, "Home About glow Glow GLOW serum", domain) == want
    assert one(spark, text.content_words, "foo\nbar", "x.com") == "foobar"
    assert one(spark, text.content_words, None, "x.com") == ""
    many = " ".join(f"w{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}x" for i in range(100))
    assert len(one(spark, text.content_words, many, "x.com").split()) == rules.MAX_WORDS


def test_clean_and_gate(spark):
    assert [one(spark, text.clean_field, x) for x in (None, " none ", "", 'He said "hi"')] == ["", "", "", "He said 'hi'"]
    assert one(spark, text.needs_translation, "a" * 17 + "ééé") is True  # 0.85 exactly
    assert one(spark, text.needs_translation, "a" * 86 + "é" * 14) is False
    assert one(spark, text.needs_translation, "é" * 9) is False


def test_phones_have_ten_to_fifteen_digits(spark):
    assert one(spark, html.phones, "5550102 or 4155550101 or +1 415 555 0100") == "+1 415 555 0100 | 4155550101"
    assert one(spark, html.phones, "5550102") is None


def test_page_features(spark):
    rows = {r["page_id"]: r for r in leads.enrich(fx.frame(spark, fx.PAGES), keep=("page_id",)).collect()}
    assert rows[-1]["Brand_Stage"] == "Pre-Launch" and rows[-1]["Title"] == "Soon" and rows[-1]["Socials_Found"] == "Instagram"
    assert rows[-2]["Socials_Found"] == "Twitter/X + YouTube" and rows[-2]["Emails"] == "sales@brand.io"
    assert rows[-3]["Tech_Stack_Ads"] == "Google Ads + Klaviyo + TikTok Ads" and rows[-3]["Business_Type"] == "💻 SaaS / Software"
    assert rows[-4]["Page_Text"] == "" and rows[-4]["Title"] is None
    assert {r["page_id"] for r in leads.useful(leads.enrich(fx.frame(spark, fx.PAGES), keep=("page_id",))).collect()} == {-1, -2, -3}


def test_egress_and_ingress_are_inverse(spark):
    found = leads.enrich(fx.frame(spark, fx.PAGES))
    assert sorted(map(str, leads.ingress(leads.egress(found)).collect())) == sorted(map(str, found.collect()))


def test_only_phones_are_not_useful(spark):
    row = {c: None for c in rules.LEAD_COLUMNS} | {"Domain": "a.com", "Phones": "4155550101", "Title": "T", "Intent_Trust": "E-Com"}
    frame = spark.createDataFrame([row, row | {"Tech_Stack_Ads": "Shopify"}], ", ".join(f"{c} string" for c in rules.LEAD_COLUMNS))
    assert leads.useful(frame).count() == 1


def test_classes_are_disjoint_and_labels_complete(spark):
    frame = fx.frame(spark, fx.LEADS)
    got = {r["Domain"]: r["lead_class"] for r in labelling.split_classes(frame).collect()}
    assert got == {"a.com": "parked", "b.com": "prelaunch", "c.com": "ai", "d.com": "parked", "e.com": "no_content", "f.com": "ai", "g.com": "no_content", "h.com": "prelaunch"}
    labelled = labelling.label(frame, labelling.rule_model)
    assert labelled.columns[:3] == rules.LABEL_COLUMNS and labelled.count() == frame.count()
    assert {r["Domain"]: r["Pitch_Category"] for r in labelled.collect()}["f.com"].startswith("🤖 2. SaaS/Tech (")


def test_a_failing_model_gives_defaults(spark):
    def broken(_: str) -> str:
        raise TimeoutError

    got = {r["Domain"]: r for r in labelling.label(fx.frame(spark, fx.LEADS), broken, sleep=lambda _: None).collect()}
    assert got["f.com"]["Pitch_Category"] == rules.GENERAL and got["f.com"]["Business_Type"] == rules.REVIEW


def test_pending_by_what_was_tried(spark):
    a = spark.createDataFrame([("x",), (" y ",), ("",), ("y",), (None,)], "value string")
    keys = incremental.clean_keys(a)
    assert sorted(r[0] for r in keys.collect()) == ["x", "y"]
    assert [r[0] for r in incremental.pending(keys, spark.createDataFrame([("x",), ("x",)], "value string"), "value").collect()] == ["y"]


def test_title_case_and_strip(spark):
    assert one(spark, text.title_case, "my-brand2go") == "My-Brand2Go"
    assert one(spark, text.strip, "  a b\t\n") == "a b"


def test_plans_stay_in_the_jvm(spark):
    plan = fx.frame(spark, fx.TEXTS).select(html.emails(F.col("text")), text.content_words(F.col("text"), F.lit("a.com")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_answers_and_labels_worked_out_by_hand(spark):

    want = [
        (0, None, 0, 0, "a.com", "🛠️ 5. Service Agencies (Books)", "Press", ""),
        (1, None, 0, 1, "b.com", "🟢 6. General Contacts", "", ""),
        (1, None, 1, 2, "b.com", "x", "B", "P"),
        (2, None, 0, 0, "", "y", "C", "Q"),
        (3, "JSON_ERROR", None, None, "", None, None, None),
        (4, None, 0, None, "d.com", "z", "", ""),
    ]
    got = labelling.parse_answers(fx.frame(spark, fx.RESPONSES)).select("batch", "error", "pos", "index", "domain", "pitch", "biz", "prod").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    labels = ["🟢 6. General Contacts", "🟢 6. General Contacts", "🎬 4. Video-First Brands (Film)", "🛠️ 5. Service Agencies (Law)", "🛠️ 5. Service Agencies (Books)", "🛠️ 5. Service Agencies", "A long way to a writer", "🤖 2. SaaS/Tech (Tech)", "🤖 2. SaaS/Tech (My-Brand2Go)", "🤖 2. SaaS/Tech (General)", "💰 3. D2C Ad Spenders (Legal)", "💰 3. D2C Ad Spenders (Fashion)", "🟢 6. General Contacts"]
    rows = fx.frame(spark, fx.PITCHES)
    found = {tuple(r)[:4]: r[4] for r in rows.select("*", classify.normalise_category(*(F.col(c) for c in ("pitch", "domain", "biz", "prod"))).alias("x")).collect()}
    assert [found[x] for x in fx.PITCHES[1]] == labels


def test_shapes_of_answers(spark):
    """The first list in the order of the text counts, whatever its key, an empty one too; odd keys do no harm."""
    raw = ['{"z": [{"index": 1}], "a": [{"index": 2}]}', '{"a.b": 3, "it\'s": [{"index": "4", "domain": {"x": 1}}], "q\\"q": [{"index": 9}]}', "[]", '{"items": [], "other": [{"index": 5}]}', '"text"', "7", None, '{"index": 6, "domain": "d"}', '[{"index": 7.5}, null, [1]]']
    got = labelling.parse_answers(spark.createDataFrame(list(enumerate(raw)), "batch long, raw string"))
    assert sorted((r["batch"], r["error"], r["index"]) for r in got.collect()) == [(0, None, 1), (1, None, 4), (4, "JSON_ERROR", None), (5, "JSON_ERROR", None), (6, "JSON_ERROR", None), (7, None, 6), (8, None, None)]
    assert str(got._jdf.queryExecution().optimizedPlan().toString()).count("try_parse_json") + got._jdf.queryExecution().optimizedPlan().toString().count("parseJson") <= 1


def test_page_nodes(spark):
    """Only the kinds asked for, in their order; pages that are null, empty or broken have none."""
    page = "<title>T</title><a href='/1'>One</a> text <a href='/2'>Two</a><a href='/1'>Three</a><meta name='description' content='d'>"
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<<<a href="), (5, page)], "id int, html string")
    found = html.page_nodes(df, "html", "href", "description")
    one = [("description", 0, "d"), ("href", 0, "/1"), ("href", 1, "/2"), ("href", 2, "/1")]
    assert sorted(map(tuple, found.select("id", "kind", "at", "value").collect())) == [(k, *x) for k in (1, 5) for x in one]
    assert "ArrowEvalPythonUDTF" in found._jdf.queryExecution().toString()


def test_references_without_an_end_stay_as_they_stand(spark):
    page = "<title>a &amp;&amp</title><a href='/x?a=1&copy=2&amp;b'>&lt;b&gt; &am &#39;&#39 &ampx; & co</a>"
    got = spark.createDataFrame([(page,)], "h string").select(html.parse_html("h").alias("p")).select("p.*").first()
    assert (got["title"], got["hrefs"], got["nav"]) == ("a &&amp", ["/x?a=1&copy=2&b"], ["<b> &am '&#39 &ampx; & co"])


def test_capitals_are_one_character_each(spark):
    """All characters of the first plane, as the SQL's engine has them."""
    import duckdb

    codes = [k for k in range(1, 0x10000) if not 0xD800 <= k < 0xE000]
    want = dict(duckdb.execute("select i, upper(chr(i)) from (select unnest(?::int[]) as i)", [codes]).fetchall())
    got = dict(map(tuple, spark.createDataFrame([(k, chr(k)) for k in codes], "k int, c string").select("k", text.capitals(F.col("c"))).collect()))
    assert {k: got[k] for k in codes if len(chr(k).upper()) > 1} == {k: want[k] for k in codes if len(chr(k).upper()) > 1}
    assert one(spark, text.capitals, "stra\xdfe\n\xe9\ufb01x") == "STRA\u1e9eE\n\xc9\ufb01X" and one(spark, text.capitals, "") == "" and one(spark, text.capitals, None) is None


def test_translations_are_whole(spark, tmp_path):
    """Texts beyond the width of a lead's columns, translated or not, null and short ones."""
    from siftworks.plans import catalogue

    rows = [(1, "стра\xdfe " * 300 + "end"), (2, "plain words " * 300 + "end"), (3, None), (4, "é" * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = dict(map(tuple, catalogue.QUERIES["translated"](spark, str(tmp_path)).where("doc_id > 0").collect()))
    assert got == {1: "[en] " + "СТРА\u1e9eE " * 300 + "END", 2: rows[1][1], 3: None, 4: "é" * 9}


def test_few_pages_are_held_at_a_time(spark):
    import pyarrow as pa

    pages = ["<title>%d</title>" % k for k in range(150)] + [None]
    got = list(html.parse_html.func(iter([pa.array(pages), pa.array([], pa.string()), pa.array(pages[:3])])))
    assert max(map(len, got)) <= 64 and sum(map(len, got)) == 154
    df = spark.createDataFrame(list(enumerate(pages)), "k int, h string").coalesce(1)
    assert {r[0]: r[1] for r in df.select("k", html.parse_html("h")["title"]).collect()} == {k: p and p[7:-8] for k, p in enumerate(pages)}


def test_long_texts_and_their_beginnings(spark, monkeypatch):
    """Where the beginning decides, and where it doesn't: few distinct words, and words that the beginning's end would cut or join."""
    texts = ["same word " * 400, "abc​def " * 200 + "ghi", " ".join(f"w{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]}x" for i in range(900)), "x" * 1499 + "yz abc", "x" * 1498 + "​​yz abc", "- " * 2000 + "late words here", "a1 " * 700, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = df.select("k", text.content_words(F.col("t"), F.lit("x.com")), text.content_reaches(F.col("t"), F.lit("x.com"), 10)).collect()
    monkeypatch.setattr(text, "BEGINNING", 1 << 20)
    want = df.select("k", text.content_words(F.col("t"), F.lit("x.com")), text.content_reaches(F.col("t"), F.lit("x.com"), 10)).collect()
    assert got == want and [r[2] for r in got] == [True, True, True, True, True, True, False, False, False]


def test_requests_number_what_is_told(spark):
    """Whole texts aren't moved, and the requests are those of the leads."""
    df = spark.createDataFrame([(f"d{k}.com", "Live", f"T{k}", None, f"serum number{k} " * 300) for k in range(12)], "Domain string, Brand_Stage string, Title string, Meta_Description string, Page_Text string")
    assert "Page_Text" not in labelling.number_batches(labelling.told(df), "Domain").columns
    rows = [{tuple(r) for r in labelling.requests(labelling.number_batches(x, "Domain")).collect()} for x in (labelling.told(df), df)]
    assert rows[0] == rows[1] and len(rows[0]) == 3
