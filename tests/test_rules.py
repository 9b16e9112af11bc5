"""Literal edge rows: one scenario per rule of the correction job.

All scenarios share one catalogue (their slugs never meet), so the
cascade runs once for the whole module.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from slugmend import schemas as S
from slugmend.plans import correction

# (sku, product, link, active)
CATALOG = [
    # suffix meets a plain slug: "a" held nowhere; SKU 2 of "A" collides with "a"
    ("1", 1, "a", True),          # already right
    ("2", 2, "A", True),          # -> a is held by 1 -> a-2
    ("3", 3, "A-2", True),        # -> a-2, taken by SKU 2 just before
    # irresolvable: b held, b-7 held, SKU 7 has "B"
    ("5", 5, "b", True),
    ("6", 6, "b-7", True),
    ("7", 7, "B", True),
    # update failure frees the name: first update fails, second gets c-d
    ("10", 10, "C_d", True),
    ("11", 11, "c_D", True),
    # case-only change: one redirect /EFG/p -> /efg/p
    ("20", 20, "EFG", True),
    # shadowed live URL: h-i held by 30; 31 has "H-i" -> h-i-31, redirect from /h-i/p
    ("30", 30, "h-i", True),
    ("31", 31, "H-i", True),
    # in-batch redirect seen by a later item: "J_k" creates /j_k/p, "j_k" (product 41) finds it
    ("40", 40, "J_k", True),
    ("41", 41, "j_k", True),
    # null active flag counts as inactive
    ("50", 50, "Mm", None),
    # null and empty slugs
    ("60", 60, None, True),
    ("61", 61, "***", True),
    # failing second redirect: exact path ok, lower path fails
    ("70", 70, "Pq_R", True),
    # two SKUs of one product: the second finds the slug fixed
    ("80", 80, "S T", True),
    ("81", 80, "S T", True),
]
PUT_FAILS = {10: "HTTP 500"}
REDIRECT_FAILS = {"/pq_r/p": "quota"}
REGISTRY = {"/mm/p": "/somewhere/p"}
BATCH = [c[0] for c in CATALOG if c[0] != "1"] + ["999", "80"]


@pytest.fixture(scope="module")
def rows(spark):
    cat = spark.createDataFrame(CATALOG, "sku_id string, product_id bigint, link_id string, is_active boolean")
    reg = spark.createDataFrame(sorted(REGISTRY.items()), "from_path string, to_path string")
    put = spark.createDataFrame([(k, True, v) for k, v in PUT_FAILS.items()], "product_id bigint, erro boolean, msg string")
    red = spark.createDataFrame([(k, True, v) for k, v in REDIRECT_FAILS.items()], "from_path string, erro boolean, msg string")
    batch = spark.createDataFrame([(s,) for s in BATCH], "sku_id string")
    out, _ = correction.cascade(batch, cat, reg, put, red, None)
    by_sku: dict[str, list[dict]] = {}
    for r in out.collect():
        by_sku.setdefault(r["sku_id"], []).append(r.asDict())
    return by_sku


def one(rows, sku):
    assert len(rows[sku]) == 1, rows[sku]
    return rows[sku][0]


def test_every_listed_sku_gets_one_row_per_listing(rows):
    assert sum(len(v) for v in rows.values()) == len(BATCH)
    assert all(r["status"] in S.ALL_STATUSES for v in rows.values() for r in v)


def test_suffix_after_collision_and_suffix_blocking_plain(rows):
    r2 = one(rows, "2")
    assert (r2["status"], r2["slug_final"], r2["houve_colisao"], r2["product_id_conflitante"]) == (
        S.SUCESSO, "a-2", True, 1)
    r3 = one(rows, "3")  # its plain slug a-2 was just taken by SKU 2, and a-2-3 is free
    assert (r3["status"], r3["slug_final"], r3["product_id_conflitante"]) == (S.SUCESSO, "a-2-3", 2)


def test_irresolvable_collision(rows):
    r = one(rows, "7")
    assert r["status"] == S.ERRO_COLISAO_IRRESOLVIVEL
    assert r["slug_final"] is None and r["houve_colisao"] and r["product_id_conflitante"] == 5
    assert r["mensagem_erro"] == S.MSG_IRRESOLVABLE.format(5)


def test_failed_update_frees_the_name(rows):
    assert one(rows, "10")["status"] == S.ERRO_PUT
    assert one(rows, "10")["slug_final"] == "c-d"
    r = one(rows, "11")
    assert (r["status"], r["slug_final"], r["houve_colisao"]) == (S.SUCESSO, "c-d", False)


def test_case_only_change_plans_one_redirect(rows):
    r = one(rows, "20")
    assert (r["status"], r["redirect_destino"], r["redirect_confirmado"]) == (S.SUCESSO, "/efg/p", True)
    assert r["mensagem_erro"] is None


def test_shadowed_live_url(rows):
    r = one(rows, "31")
    assert (r["status"], r["slug_final"], r["product_id_conflitante"]) == (S.SUCESSO, "h-i-31", 30)


def test_in_batch_redirect_is_seen_and_removed_by_a_later_item(rows):
    assert one(rows, "40")["status"] == S.SUCESSO
    r = one(rows, "41")
    assert r["status"] == S.SUCESSO
    assert r["mensagem_erro"] == S.MSG_REMOVED.format("/j-k/p")


def test_null_active_is_inactive(rows):
    r = one(rows, "50")
    assert (r["status"], r["is_active"], r["slug_normalizado"]) == (S.PULADO_INATIVO, None, None)


def test_null_and_empty_slugs_are_api_errors(rows):
    assert one(rows, "60")["status"] == S.ERRO_API
    r = one(rows, "61")
    assert (r["status"], r["slug_normalizado"]) == (S.ERRO_API, "")


def test_second_redirect_failure(rows):
    r = one(rows, "70")
    assert r["status"] == S.ERRO_REDIRECT
    assert (r["put_confirmado"], r["redirect_confirmado"], r["redirect_destino"]) == (True, False, "/pq-r/p")
    assert r["mensagem_erro"] == S.MSG_REDIRECT_FAILED.format("/pq_r/p", "quota")


def test_later_sku_and_repeat_of_a_fixed_product(rows):
    first = [r for r in rows["80"] if r["status"] == S.SUCESSO]
    again = [r for r in rows["80"] if r["status"] == S.PULADO_JA_CORRIGIDO]
    assert len(first) == 1 and len(again) == 1
    assert again[0]["slug_original"] == "s-t"
    r81 = one(rows, "81")
    assert (r81["status"], r81["slug_original"], r81["houve_colisao"]) == (S.PULADO_JA_CORRIGIDO, "s-t", False)


def test_unknown_sku(rows):
    r = one(rows, "999")
    assert r["status"] == S.ERRO_API and r["product_id"] is None
    assert r["mensagem_erro"] == S.MSG_LOOKUP_FAILED.format(S.NOT_FOUND_SKU)


def test_steps_of_resolution_do_not_grow_with_levels(spark, monkeypatch):
    """Stems at twelve different levels, two claims each: one step for all, and one for the claims that move up."""
    from slugmend.operators import collisions

    names = []
    whole = collisions.materialise
    monkeypatch.setattr(collisions, "materialise", lambda df, name: names.append(name) or whole(df, name))
    slug = lambda i: f"stem{'abcdefghijkl'[i]}" + "-7" * i
    rows = [(f"i{i}{j}", 10 * i + j, 10 * i + j, str(100 + 10 * i + j), slug(i), True) for i in range(12) for j in range(2)]
    claims = spark.createDataFrame(rows, "item_id string, okey long, product_id long, sku string, slug string, eligible boolean")
    claims = claims.withColumn("okey", F.struct(F.col("okey").alias("num")))
    products = spark.createDataFrame([], "product_id long, link_id string, is_active boolean")
    out = collisions.resolve_claims(collisions.prepare_claims(claims, products)).collect()
    assert sum(n.startswith("level") for n in names) == 2
    got = {r.item_id: (r.outcome, r.slug_final) for r in out}
    want = {f"i{i}0": ("WIN", slug(i)) for i in range(12)} | {f"i{i}1": ("WIN", f"{slug(i)}-{101 + 10 * i}") for i in range(12)}
    assert got == want
