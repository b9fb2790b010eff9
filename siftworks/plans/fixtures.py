"""Small literal tables that stand beside the driver's tables where those lack a signal; the same rows in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOMAINS = ("domain string", [(d,) for d in ("glow.com", "GLOW.COM", "ab.com", ".com", "", "localhost", "abc.xyz", "mailbox.xyz", "a-b-c.com", "x1234.com", "x123.com", "a" * 22 + ".com", "a" * 23 + ".com", "www.shopify-clone.biz", "foo.com.", " padded.io\t")])

PAGES = (
    "page_id long, url string, html string",
    [
        (-1, "http://brand.example", "<html><head><title> Soon </title><meta name='description' content='Coming soon: a new serum'></head><body><a href='https://www.instagram.com/x'>Insta</a> fbq('init') <a href='/shop'>Shop Now</a></body></html>"),
        (-2, "http://shop.example", "<title>Shop</title><meta property='og:description' content='We sell tea'><p>password</p> shopify webflow add to cart sales@brand.io help@example.com +1 415 555 0100 4155550101 5550102</p><a href='https://netflix.com/a'>N</a><a href='https://www.youtube.com/c'>Y</a><button href='/go'>Go</button>"),
        (-3, "http://saas.example", "<p>Book a demo of our workflow platform. gtag( klaviyo tiktok pixel linktree</p><a href='https://LinkedIn.com/company/x'>L</a><a href='https://facebook.com/x'>F</a><a href='https://tiktok.com/@x'>T</a>"),
        (-4, "http://empty.example", ""),
        (-5, "http://drawn.example", "<html><head><title>Two titles</title></head><body><svg><title>Facebook icon</title></svg><svg><title>Cart</title></svg><!-- no <b>text</b> --><p>Our tables are made of oak, one by one. Our tables are made of oak, one by one! Drawn by hand, cut by hand, oiled by hand</p></body></html>"),
        (-6, "http://drawn.example", "<title></title><title>The first is empty</title><p>drawn.example begins with its own name and is left out. A second page of the same host, with words of its own</p>"),
        (-7, "http://nginx.example", "<title>Welcome to nginx</title><p>Nothing here yet, friends</p>"),
    ],
)

LEADS = (
    "Domain string, Brand_Stage string, Title string, Meta_Description string, Page_Text string",
    [
        ("a.com", "Live", "Welcome to nginx", None, "default page"),
        ("b.com", "Pre-Launch", "Brand", None, ""),
        ("c.com", "Pre-Launch | Using Link-in-Bio", "Brand", None, "nothing much to read here today friends"),
        ("d.com", "Live", "Parked domain", None, "coming soon"),
        ("e.com", "Live", "None", "none", "home about"),
        ("f.com", "Live", "Glow serum for your skin", "A serum", "glow Glow GLOW serum vitamin skin care for everyone"),
        ("g.com", None, None, None, None),
        ("h.com", "Live", "We're under construction", "x", "y"),
    ],
)

PITCHES = (
    "pitch string, domain string, biz string, prod string",
    [
        (None, "a.com", "", ""),
        ("", "a.com", "", ""),
        ("🍺 4. Video-First Brands (Film)", "a.com", "", ""),
        ("⚖️ 5. Service Agencies (Law)", "a.com", "", ""),
        ("Author (Books)", "a.com", "", ""),
        ("The blogger", "a.com", "", ""),
        ("A long way to a writer", "a.com", "", ""),
        ("🤖 2. SaaS/Tech (NICHE)", "a.com", "Hair Salon", ""),
        ("🤖 2. SaaS/Tech (niche)", "my-brand2go.io", "", ""),
        ("🤖 2. SaaS/Tech (Niche)", "", "", None),
        ("💰 3. D2C Ad Spenders (NICHE)", "x.com", "Legal firm", "Attorney"),
        ("💰 3. D2C Ad Spenders (NICHE)", "x.com", "Textile mill", ""),
        ("🟢 6. General Contacts", "x.com", "", ""),
    ],
)

RESPONSES = (
    "batch long, raw string",
    [
        (0, '```json\n{"items": [{"index": 0, "domain": "a.com", "pitch_category": "Author (Books)", "true_business_type": "Press", "true_product_category": "Unknown"}]}\n```'),
        (1, '{"results": [{"index": "1", "domain": "b.com", "pitch_category": "", "true_business_type": "Unknown"}, {"index": 2, "domain": "b.com", "pitch_category": "x", "true_business_type": "B", "true_product_category": "P"}]}'),
        (2, '{"index": 0, "domain": "", "pitch_category": "y", "true_business_type": "C", "true_product_category": "Q"}'),
        (3, "no json at all"),
        (4, '[{"domain": "d.com", "pitch_category": "z"}, 7]'),
    ],
)
ANSWERED = ("batch long, error string, tries int", [(0, None, 1), (1, None, 3), (2, "TIMEOUT", 3), (4, "RATE_LIMITED", 3)])
TEXTS = ("doc_id long, text string", [(-1, 'He said "hi" \\ bye'), (-2, " none "), (-3, ""), (-4, None), (-5, "foo\nbar 😀 baz qux"), (-6, "ééééééééé plain"), (-7, "a" * 17 + "ééé"), (-8, "a" * 86 + "é" * 14), (-9, "mail me: jo.doe@firm.io or x@test.com, 020 7946 0018 0"), (-10, "Home About glow Glow GLOW serum")])

ARCHIVE = ("dt string, head string", [("2024-01-01", "x" * 60), ("2024-01-02", "NO_DATA" + "x" * 60), ("2024-01-03", "y" * 49), ("2024-01-04", "z" * 50), ("2024-01-06", "w" * 250)])


def frame(spark: SparkSession, fixture: tuple[str, list[tuple]]) -> DataFrame:
    return spark.createDataFrame(fixture[1], fixture[0])


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def sql(fixture: tuple[str, list[tuple]]) -> str:
    """A SELECT over the rows, with types."""
    kinds = {"string": "VARCHAR", "long": "BIGINT", "int": "INT"}
    columns = [x.split() for x in fixture[0].split(", ")]
    rows = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in fixture[1])
    cast = ", ".join(f"c{i}::{kinds[k]} AS {n}" for i, (n, k) in enumerate(columns))
    return f"SELECT {cast} FROM (VALUES {rows}) v({', '.join(f'c{i}' for i in range(len(columns)))})"
