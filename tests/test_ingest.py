"""Feed pages: decoding, validity and run accounting."""

import datetime as dt
import json

import pytest

from shelfpulse.operators import ingest, quality
from shelfpulse.schemas import PAGES, REGISTRY
from shelfpulse.session import SETTINGS
from shelfpulse.sources.registry import enabled, read_registry

START = dt.datetime(2024, 5, 1, 6, 10)


def pages(spark, *landed):
    rows = [
        (run, merchant, page, status, body, START + dt.timedelta(seconds=10 * run + page))
        for run, merchant, page, status, body in landed
    ]
    return spark.createDataFrame(rows, PAGES)


def registry(spark, **methods):
    rows = [
        (slug, slug.title(), method, f"https://{slug}.example", "USD", slug != "off", "")
        for slug, method in methods.items()
    ]
    return spark.createDataFrame(rows, REGISTRY)


def feed(*products):
    return json.dumps({"products": list(products)})


def product(number, *variants):
    return {"id": number, "title": f"P{number}", "variants": list(variants)}


GOOD = "shopify_products_json"


def account(spark, landed, page_limit=2, max_pages=3, **methods):
    landed_pages = pages(spark, *landed)
    runs = ingest.derive_runs(
        ingest.page_facts(landed_pages), registry(spark, **(methods or {"a": GOOD})), page_limit, max_pages
    )
    return landed_pages, runs, {r.id: r for r in runs.collect()}


def test_decode_keeps_json_types(spark):
    body = feed({
        "id": 1, "handle": "h", "title": "Thing", "vendor": None, "product_type": "",
        "images": [{"src": "https://x/p.png?v=3"}],
        "variants": [
            {"id": 10, "title": "V", "price": "2.50", "compare_at_price": None, "available": True, "sku": "S"},
            {"id": 11, "price": 2.5, "available": "true", "sku": 12, "featured_image": {"src": "https://x/v.png"}},
            {"id": "k", "price": 1e-7, "available": None, "sku": "", "featured_image": {"src": ""}},
            {"price": "abc", "available": 0, "title": ["odd"]},
        ],
    })
    landed, runs, _ = account(spark, [(1, "a", 1, 200, body)])
    rows = {r.variant_ext_id: r for r in ingest.decode_pages(landed, runs).collect()}
    assert set(rows) == {"10", "11", "k", "undefined"}
    assert [rows[k].available for k in ("10", "11", "k", "undefined")] == [True, None, None, None]
    assert [rows[k].price_raw for k in ("10", "11", "k", "undefined")] == ["2.50", "2.5", "0.0000001", "abc"]
    assert [rows[k].sku_is_text for k in ("10", "11", "k", "undefined")] == [True, False, True, None]
    assert rows["10"].image_url == "https://x/p.png" and rows["11"].image_url == "https://x/v.png"
    assert rows["k"].image_url == "https://x/p.png"
    assert rows["10"].currency == "USD" and rows["10"].product_ext_id == "1"
    assert len({r.observed_at for r in rows.values()}) == 1
    graded = {r.variant_ext_id: r for r in quality.grade(ingest.decode_pages(landed, runs)).collect()}
    assert [graded[k].sku_status for k in ("10", "11", "k", "undefined")] == ["ok", "invalid", "missing", "missing"]
    assert graded["k"].price_status == "ok" and graded["undefined"].variant_title_status == "invalid"


def test_lists_are_read_in_one_cast(spark):
    """No list is built anew as VARIANT for each value read from it, and products are done with before their variants."""
    landed, runs, _ = account(spark, [(1, "a", 1, 200, feed(product(1, {"id": 1})))])
    plan = ingest.decode_pages(landed, runs)._jdf.queryExecution().optimizedPlan().toString()
    assert "array<variant>" not in plan
    above, _, _ = plan.partition("posexplode(variants")
    assert "images" not in above and "vendor" in above


def test_odd_lists_and_items(spark):
    """Items that are no object are readings without a value; nulls, and lists that are none, make a feed unusable."""
    kept = [5, {"id": 1, "variants": [7, "x", [], {"id": 2}]}, {"id": 2}, {"id": 3, "variants": None}]
    bodies = [feed(*kept), feed(*kept, None), feed({"variants": [{}, None]}), feed({"variants": 5}), feed({"variants": {}}),
              json.dumps({"products": 5}), json.dumps({"products": None}), "[]", "null"]
    landed, runs, _ = account(spark, [(n, "a", 1, 200, body) for n, body in enumerate(bodies)], page_limit=9)
    facts = {r.run_id: (r.n_products, r.n_variants, r.misshapen) for r in ingest.page_facts(landed).collect()}
    assert [facts[n][2] for n in range(len(bodies))] == [False, True, True, True, True, True, False, False, True]
    assert facts[0] == (4, 4, False) and facts[6] == facts[7] == (0, 0, False)
    rows = sorted(ingest.decode_pages(landed, runs).where("run_id = 0").collect(), key=lambda r: r.id)
    assert [(r.id - (1 << 31), r.product_ext_id, r.variant_ext_id) for r in rows] == [
        (0, "1", "undefined"), (1, "1", "undefined"), (2, "1", "undefined"), (3, "1", "2")]


def test_run_ends_at_first_short_page(spark):
    full, short = feed(product(1, {"id": 1}), product(2, {"id": 2})), feed(product(3, {"id": 3}))
    _, _, runs = account(spark, [
        (1, "a", 1, 200, full), (1, "a", 2, 200, short), (1, "a", 3, 500, "never asked for"),
    ])
    assert (runs[1].ok, runs[1].products_seen, runs[1].variants_seen, runs[1].truncated) == (1, 3, 3, False)
    assert runs[1].bytes == len(full) + len(short) and runs[1].duration_ms == 1000


def test_failures_void_the_run(spark):
    full = feed(product(1, {"id": 1}), product(2, {"id": 2}))
    landed, decoded_runs, runs = account(
        spark,
        [
            (1, "a", 1, 200, full), (1, "a", 2, 503, "busy"),
            (2, "a", 1, 200, "<html>" + "x" * 80),
            (3, "b", 1, 200, full),
            (4, "a", 1, None, None),
            (5, "a", 1, 200, "null"),
            (6, "a", 1, 200, '{"products":{"a":1}}'),
            (7, "a", 1, 200, feed(None)),
            (8, "off", 1, 200, feed()),
            (9, "a", 1, 200, full),
        ],
        a=GOOD, b="permission_required", off=GOOD,
    )
    assert {i: r.ok for i, r in runs.items()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 9: 0}
    assert (runs[1].error, runs[1].http_status) == ("HTTP 503 on page 2", 503)
    assert runs[2].error == "unparseable JSON on page 1 (<html>" + "x" * 54 + "…)"
    assert runs[2].http_status == 200
    assert (runs[3].error, runs[3].http_status) == ('method "permission_required" has no adapter yet', None)
    assert runs[4].error == "no response on page 1"
    assert {runs[i].error for i in (5, 6, 7)} == {"unusable feed on page 1"}
    # A full last page below the page limit: the run stopped without an end.
    assert (runs[9].finished_at, runs[9].error, runs[9].duration_ms) == (None, None, None)
    assert all((r.products_seen, r.variants_seen, r.bytes) == (0, 0, 0) for r in runs.values())
    assert ingest.decode_pages(landed, decoded_runs).isEmpty()


def test_equal_copies_of_a_page_count_once(spark):
    full, short = feed(product(1, {"id": 1}), product(2, {"id": 2})), feed(product(3, {"id": 3}))
    landed, decoded_runs, runs = account(spark, [
        (1, "a", 1, 200, full), (1, "a", 2, 200, short), (1, "a", 2, 200, short), (2, "a", 1, 200, short),
    ])
    assert (runs[1].ok, runs[1].error, runs[1].variants_seen) == (1, None, 3)
    decoded = ingest.decode_pages(landed, decoded_runs).collect()
    assert sorted((r.run_id, r.variant_ext_id) for r in decoded) == [(1, "1"), (1, "2"), (1, "3"), (2, "3")]
    assert len({(r.run_id, r.id) for r in decoded}) == 4


def test_differing_copies_of_a_page_fail_the_run(spark):
    short, other = feed(product(3, {"id": 3})), feed(product(4, {"id": 3}))
    landed, decoded_runs, runs = account(spark, [
        (1, "a", 1, 200, short), (1, "a", 1, 200, other), (2, "a", 1, 200, short),
    ])
    assert (runs[1].ok, runs[1].error, runs[1].variants_seen) == (0, "page 1 landed with different contents", 0)
    assert [r.run_id for r in ingest.decode_pages(landed, decoded_runs).collect()] == [2]


def test_empty_feed_is_a_successful_run(spark):
    for body in ('{"products":[]}', "{}", '{"products":null}'):
        _, _, runs = account(spark, [(1, "a", 1, 200, body)])
        assert (runs[1].ok, runs[1].variants_seen, runs[1].error) == (1, 0, None)


def test_repeated_json_keys(spark):
    """The last one counts, as the recommended settings say."""
    name = "spark.sql.variant.allowDuplicateKeys"
    body = '{"products":null,"products":[{"id":1,"id":2,"variants":[]}]}'
    try:
        spark.conf.set(name, SETTINGS[name])
        _, _, runs = account(spark, [(1, "a", 1, 200, body)])
        assert (runs[1].ok, runs[1].products_seen) == (1, 1)
    finally:
        spark.conf.unset(name)
    _, _, runs = account(spark, [(1, "a", 1, 200, body)])
    assert runs[1].error.startswith("unparseable JSON on page 1")


def test_all_landed_pages_count(spark):
    full = feed(product(1, {"id": 1}), product(2))
    landed, runs_df, runs = account(spark, [(1, "a", n, 200, full) for n in (1, 2, 3, 4)])
    assert (runs[1].ok, runs[1].products_seen, runs[1].truncated) == (1, 8, True)
    assert ingest.decode_pages(landed, runs_df).count() == 4


def test_run_without_pages_is_recorded(spark):
    landed = pages(spark, (1, "a", 1, 200, "{}"))
    starts = spark.createDataFrame(
        [(1, "a", START), (2, "a", START), (3, "b", START)], "run_id bigint, merchant string, started_at timestamp"
    )
    merchants = registry(spark, a=GOOD, b="permission_required")
    rows = ingest.derive_runs(ingest.page_facts(landed), merchants, 2, 3, starts).collect()
    runs = {r.id: r for r in rows}
    assert [runs[i].ok for i in (1, 2, 3)] == [1, 0, 0]
    assert all(runs[i].started_at == START for i in (1, 2, 3))
    assert (runs[2].finished_at, runs[2].error, runs[2].variants_seen) == (None, None, 0)
    assert runs[3].error == 'method "permission_required" has no adapter yet'


def test_registry(spark, tmp_path):
    path = tmp_path / "merchants.json"
    entry = {"slug": "a", "name": "A", "method": GOOD, "base_url": "u", "currency": "USD", "enabled": True}
    path.write_text(json.dumps([entry, {**entry, "slug": "b", "enabled": False}]))
    stored = read_registry(spark, str(path))
    assert [r.slug for r in enabled(stored).collect()] == ["a"]
    with pytest.raises(ValueError, match="no enabled merchant matching"):
        enabled(stored, only="b")
    with pytest.raises(ValueError, match="no enabled merchants"):
        enabled(stored.where("slug = 'b'"))
