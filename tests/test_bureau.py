"""Generated tables: determinism, domains, rates, keys, and the views over them."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lockgate.functions import documents
from lockgate.functions.draws import Draws, with_state
from lockgate.operators import reconcile
from lockgate.plans import analytics
from lockgate.plans import bureau as B
from lockgate.sources import scratch, tables

RECIPE = B.Recipe(dt.date(2024, 6, 30), clients=400)
SIZES = B.Sizes(400, 80, 500, 600, 300, 250)


@pytest.fixture(scope="module")
def made(spark):
    return B.generate(spark, RECIPE, SIZES)


def test_sizes_and_keys(spark, made):
    counts = {n: df.count() for n, df in made.items() if n != "contatos"}
    assert counts == {
        "clientes_pf": 400, "clientes_pj": 80, "enderecos": 480, "score_historico": 9600, "consultas_credito": 500,
        "limites_credito": 400, "transacoes": 600, "contratos": 300, "ocorrencias": 250, "protestos": 50,
        "catalogo_produtos": 15, "assinaturas": 600, "uso_produto": 1200, "precos_historico": 720,
    }
    assert B.Sizes().protests == 1600 and B.Sizes().subscriptions == 15_000 and B.Sizes().usages == 30_000
    for name in ("consultas_credito", "transacoes", "contratos", "ocorrencias", "protestos", "assinaturas", "uso_produto"):
        assert made[name].agg(F.min("id_cliente"), F.max("id_cliente")).first()[:] >= (1, 1)
        assert made[name].filter("id_cliente NOT BETWEEN 1 AND 400").count() == 0
    assert made["enderecos"].select("id_endereco").distinct().count() == 480


@pytest.mark.parametrize("name", ["clientes_pf", "clientes_pj", "transacoes", "contratos"])
def test_same_rows_for_any_partitioning(spark, name):
    make, rows = getattr(B, name), 200
    one = make(B.keys(spark, rows, 1), RECIPE)
    assert reconcile.multiset_diff(one, make(B.keys(spark, rows, 7), RECIPE)).count() == 0
    assert reconcile.multiset_diff(one, make(B.keys(spark, rows, 1), B.Recipe(RECIPE.as_of, 400, seed=7))).count() > 0


def test_contacts(made):
    rows = made["contatos"].collect()
    per_client = Counter(r.id_cliente for r in rows)
    assert set(per_client.values()) == {1, 2, 3} and len(per_client) == 400
    assert Counter(r.id_cliente for r in rows if r.flag_principal) == Counter(dict.fromkeys(per_client, 1))
    assert len({r.id_contato for r in rows}) == len(rows)


def test_walk_is_bounded_and_steps_are_small(made):
    by_client = {}
    for r in made["score_historico"].collect():
        by_client.setdefault(r.id_cliente, []).append((r.ano_mes, r.score, r.faixa_score))
    for walk in by_client.values():
        walk.sort()
        scores = [s for _, s, _ in walk]
        assert len(walk) == 24 and walk[0][0] == 202206 and walk[-1][0] == 202405
        assert all(0 <= s <= 1000 for s in scores) and all(abs(a - b) <= 40 for a, b in zip(scores, scores[1:]))
        assert all(band == ("A" if s >= 800 else "B" if s >= 600 else "C" if s >= 400 else "D" if s >= 200 else "E") for _, s, band in walk)


def test_conditional_fields(made):
    for r in made["assinaturas"].collect():
        assert (r.dt_fim is None) == (r.status == "ATIVA") and (r.dt_proximo_cobr is not None) == (r.status == "ATIVA")
        assert r.flag_trial == (r.status == "TRIAL") and (r.motivo_cancel != "") == (r.status == "CANCELADA")
        assert r.id_produto in B.ACTIVE_PRODUCTS
        assert r.dt_fim is None or r.dt_inicio <= r.dt_fim <= RECIPE.as_of
    for r in made["contratos"].collect():
        assert 0 <= r.parcelas_pagas <= r.prazo_meses
        assert len(r.numero_contrato) == 18
    for r in made["precos_historico"].collect():
        assert r.preco_mensal >= 0 and round(r.preco_mensal * 10, 2) == r.preco_anual


def test_null_and_flag_rates(spark):
    big = B.transacoes(B.keys(spark, 40_000), RECIPE).agg(
        F.avg(F.col("dt_pagamento").isNull().cast("int")), F.avg(F.col("banco_destino").isNull().cast("int")), F.avg(F.col("flag_fraude").cast("int"))
    )
    unpaid, no_bank, fraud = big.first()
    assert abs(unpaid - 0.2) < 0.01 and abs(no_bank - 1 / 11) < 0.01 and 0.003 < fraud < 0.007


def test_draws_are_uniform_and_independent(spark):
    d = Draws("t")
    df = with_state(B.keys(spark, 100_000), "id").select(d.below("a", 10).alias("a"), d.below("b", 10).alias("b"))
    for keys in (["a"], ["b"], ["a", "b"]):
        cells = [r["count"] for r in df.groupBy(*keys).count().collect()]
        expected = 100_000 / 10 ** len(keys)
        chi2 = sum((c - expected) ** 2 / expected for c in cells) / (10 ** len(keys) - 1)
        assert len(cells) == 10 ** len(keys) and chi2 < 3
    far = with_state(spark.range(3).selectExpr("id + 5000000000000 AS id"), "id").select(d.raw("a").alias("a"))
    assert len({r.a for r in far.collect()}) == 3


def test_states_never_repeat(spark):
    """Five million keys, dense and sparse, and clients times months: no two share a state."""
    dense = spark.range(4_000_000).select(F.col("id"))
    monthly = spark.range(20_000).selectExpr("explode(sequence(0, 49)) AS m", "id + 3000000000 AS c").selectExpr(f"c * {B.MONTH_KEYS} + m AS id")
    states = with_state(dense.unionByName(monthly), "id").select("_state", "_state_2")
    assert states.distinct().count() == 5_000_000
    with pytest.raises(ValueError):
        B.score_historico(B.keys(spark, 1), RECIPE, B.MONTH_KEYS + 1)


def check_digits(text, weights):
    digits = [int(c) for c in text if c.isdigit()]
    return digits, [sum(a * b for a, b in zip(digits, w)) for w in weights]


def test_document_numbers(spark, made):
    known = spark.createDataFrame([(111444777, 112223330001)], "p bigint, c bigint")
    row = documents.with_cnpj(documents.with_cpf(known, "cpf", F.col("p")), "cnpj", F.col("c")).first()
    assert (row.cpf, row.cnpj) == ("111.444.777-35", "11.222.333/0001-81")
    for r in made["clientes_pf"].select("cpf").collect():
        digits, (a, b) = check_digits(r.cpf, documents.PERSON_WEIGHTS)
        assert [a * 10 % 11 % 10, b * 10 % 11 % 10] == digits[9:] and len(r.cpf) == 14
    texts = spark.createDataFrame([("111.444.777-35",), ("111.444.777-36",), ("11144477735",), ("",), (None,)], "t string")
    assert [r.ok for r in documents.with_cpf_valid(texts, "ok", "t").collect()] == [True, False, False, False, False]
    firms = spark.createDataFrame([("11.222.333/0001-81",), ("11.222.333/0001-80",)], "t string")
    assert [r.ok for r in documents.with_cnpj_valid(firms, "ok", "t").collect()] == [True, False]


def test_layouts(spark, made):
    base = scratch.new_folder(spark, "bureau")
    for name in ("contatos", "contratos", "precos_historico", "score_historico"):
        layout, df = B.LAYOUTS[name], made[name]
        path = B.save(spark, name, df, base)
        assert reconcile.multiset_diff(df, tables.read(spark, path, layout.fmt, df.schema)).count() == 0


def test_current_score_keeps_ties(spark):
    score_columns = "id_cliente bigint, ano_mes bigint, score bigint, faixa_score string, num_consultas_mes int, num_dividas_ativas int, valor_dividas double, flag_negativado boolean, dt_calculo date"
    rest = ("A", 1, 1, 0.0, False, dt.date(2024, 1, 1))
    scores = spark.createDataFrame([(1, 202401, 10, *rest), (1, 202402, 20, *rest), (1, 202402, 21, *rest), (2, 202401, 30, *rest)], score_columns)
    limits = spark.createDataFrame([(1, "ATIVO", 1.0, 2.0, 3.0), (2, "VENCIDO", 4.0, 5.0, 6.0)], "id_cliente bigint, status string, limite_aprovado double, limite_disponivel double, taxa_juros_mensal double")
    got = {(r.id_cliente, r.score, r.limite_aprovado) for r in analytics.current_score(scores, limits).collect()}
    assert got == {(1, 20, 1.0), (1, 21, 1.0), (2, 30, None)}


def test_clients_by_band(spark):
    clients = spark.range(1, 201).selectExpr("id", "concat('c', id) AS nome", "id * 10 AS score", "if(id % 2 = 0, 'SP', 'RJ') AS uf")
    bands = spark.createDataFrame([(1, "A", "Excelente"), (2, "B", "Bom"), (3, "C", "Regular")], "id int, codigo string, descricao string")
    got = Counter(r.faixa for r in analytics.clients_by_band(clients, bands).collect())
    assert got == {"Excelente": 61, "Bom": 15, "Regular": 24}


def test_latest_join_hashes_key_and_moment(spark):
    """The skew-prone join shuffles on both columns, not on the key alone."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).selectExpr("id % 3 AS k", "id AS ts", "id AS v")
        plan = analytics.latest(df, "k", "ts")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin") :]
    assert "hashpartitioning(k" in join and join.count("ts") > 2 and "Window" not in plan
