"""The bureau tables and views, generated from the keys of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.functions import documents
from lockgate.plans import analytics
from lockgate.plans import bureau as B
from lockgate.plans.bureau import YEAR, Recipe
from lockgate.sources import scratch
from workload.common import AS_OF, Tables, plain, plain_sql
from workload.duckdraws import DuckDraws, cnpj, cpf, period, text, with_state

QUERIES, ORACLES = {}, {}
RECIPE = Recipe(AS_OF)
PERSONS = "SELECT c_custkey AS id FROM customer"
COMPANIES = "SELECT s_suppkey AS id FROM supplier"
BY_ORDER = "SELECT o_orderkey AS id, o_custkey AS id_cliente FROM orders"
BY_EVENT = "SELECT event_id AS id, user_id AS id_cliente FROM events"
TODAY = f"DATE '{AS_OF}'"


def register(name: str, oracle: str | None, *as_text: str):
    def add(function):
        QUERIES[name] = lambda spark, sf_dir: plain(function(Tables(spark, sf_dir)))
        if oracle:
            ORACLES[name] = plain_sql(oracle, *as_text)
        return function

    return add


def persons(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"))


def companies(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("id"))


def by_order(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("id_cliente"))


def by_event(t: Tables) -> DataFrame:
    return t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("id_cliente"))


def select(columns: dict[str, str], inner: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM ({inner})"


def table(base: str, columns: dict[str, str]) -> str:
    return select(columns, with_state(base))


# ---------------------------------------------------------------- expressions


@register(
    "q_cpf",
    f"SELECT o_orderkey, {cpf('o_orderkey * 7919 % 1000000000')} AS cpf, true AS valid, false AS broken_valid FROM orders",
)
def q_cpf(t: Tables) -> DataFrame:
    df = documents.with_cpf(t.orders.select("o_orderkey"), "cpf", F.col("o_orderkey") * 7919 % 1_000_000_000)
    df = df.withColumn("broken", F.concat(F.substring("cpf", 1, 13), (F.substring("cpf", 14, 1).cast("int") + 1) % 10))
    df = documents.with_cpf_valid(documents.with_cpf_valid(df, "valid", "cpf"), "broken_valid", "broken")
    return df.drop("broken")


@register("q_cnpj", f"SELECT o_orderkey, {cnpj('o_orderkey * 104729 % 1000000000000')} AS cnpj, true AS valid FROM orders")
def q_cnpj(t: Tables) -> DataFrame:
    df = documents.with_cnpj(t.orders.select("o_orderkey"), "cnpj", F.col("o_orderkey") * 104_729 % 1_000_000_000_000)
    return documents.with_cnpj_valid(df, "valid", "cnpj")


S = DuckDraws("score_historico")
WALK = f"""WITH RECURSIVE walk AS (
  SELECT id, _state, _state_2, 0 AS m, {S.randint('start', 200, 900)} AS score FROM ({with_state(PERSONS)})
  UNION ALL
  SELECT id, _state, _state_2, m + 1, least(greatest(score + {S.randint('walk', -40, 40, '(m + 1)')}, 0), 1000) FROM walk WHERE m < {B.MONTHS_OF_HISTORY}
) SELECT id AS id_cliente, m - 1 AS m, score FROM walk WHERE m > 0"""


@register("q_walk", WALK)
def q_walk(t: Tables) -> DataFrame:
    return B.with_state(persons(t), "id", RECIPE.seed).select(
        F.col("id").alias("id_cliente"), F.posexplode(B.score_walk()).alias("m", "score")
    )


# ---------------------------------------------------------------- tables

P = DuckDraws("clientes_pf")


def full_name(d: DuckDraws, column: str, first: list[str]) -> str:
    return f"{d.choice(column + '.1', first)} || ' ' || {d.choice(column + '.2', B.SURNAMES)}"


PF = table(
    PERSONS,
    {
        "id_cliente": "id",
        "cpf": cpf(P.below("cpf", 10**9)),
        "nome": full_name(P, "nome", B.MALE + B.FEMALE),
        "nome_mae": full_name(P, "nome_mae", B.FEMALE),
        "data_nascimento": P.days_back("data_nascimento", AS_OF, 85 * YEAR, 18 * YEAR),
        "genero": P.choice("genero", B.GENDERS),
        "nacionalidade": "'Brasileira'",
        "estado_civil": P.choice("estado_civil", B.MARITAL),
        "escolaridade": P.choice("escolaridade", B.SCHOOLING),
        "renda_mensal": P.money("renda_mensal", 1320, 35000),
        "score_bureau": P.randint("score_bureau", 0, 1000),
        "faixa_score": P.choice("faixa_score", B.BANDS),
        "status": P.choice("status", B.CLIENT_STATUS),
        "uf_nascimento": P.choice("uf_nascimento", B.STATES),
        "dt_cadastro": P.days_back("dt_cadastro", AS_OF, 10 * YEAR),
        "dt_atualizacao": P.days_back("dt_atualizacao", AS_OF, YEAR),
        "flag_pep": P.flag("flag_pep", 0.02),
        "flag_obito": P.flag("flag_obito", 0.005),
        "canal_cadastro": P.choice("canal_cadastro", B.PERSON_CHANNELS),
        "origem": P.choice("origem", B.ORIGINS),
    },
)


@register("q_synth_clientes_pf", PF, "data_nascimento", "dt_cadastro", "dt_atualizacao")
def q_synth_clientes_pf(t: Tables) -> DataFrame:
    return B.clientes_pf(persons(t), RECIPE)


J = DuckDraws("clientes_pj")


def firm(column: str) -> str:
    words = [(1, B.SURNAMES), (2, B.FIRMS), (3, B.SUFFIXES)]
    return " || ' ' || ".join(J.choice(f"{column}.{i}", w) for i, w in words)


PJ = table(
    COMPANIES,
    {
        "id_empresa": "id",
        "cnpj": cnpj(J.below("cnpj", 10**12)),
        "razao_social": firm("razao_social"),
        "nome_fantasia": firm("nome_fantasia"),
        "porte": J.choice("porte", B.COMPANY_SIZES),
        "setor": J.choice("setor", B.SECTORS),
        "cnae_principal": f"{J.randint('cnae.1', 1000, 9999)} || '-' || {J.randint('cnae.2', 1, 9)} || '/' || {J.randint('cnae.3', 10, 99)}",
        "faturamento_anual": J.money("faturamento_anual", 81000, 300_000_000),
        "num_funcionarios": J.randint("num_funcionarios", 1, 5000),
        "score_bureau": J.randint("score_bureau", 0, 1000),
        "faixa_score": J.choice("faixa_score", B.BANDS),
        "status": J.choice("status", B.CLIENT_STATUS),
        "uf_sede": J.choice("uf_sede", B.STATES),
        "dt_abertura": J.days_back("dt_abertura", AS_OF, 30 * YEAR, YEAR),
        "dt_cadastro": J.days_back("dt_cadastro", AS_OF, 10 * YEAR),
        "dt_atualizacao": J.days_back("dt_atualizacao", AS_OF, YEAR),
        "capital_social": J.money("capital_social", 1000, 10_000_000),
        "optante_simples": J.flag("optante_simples", 0.4),
        "flag_mei": J.flag("flag_mei", 0.2),
        "situacao_receita": J.choice("situacao_receita", B.TAX_STATUS),
        "canal_cadastro": J.choice("canal_cadastro", B.COMPANY_CHANNELS),
    },
)


@register("q_synth_clientes_pj", PJ, "dt_abertura", "dt_cadastro", "dt_atualizacao")
def q_synth_clientes_pj(t: Tables) -> DataFrame:
    return B.clientes_pj(companies(t), RECIPE)


def address(base: str, kind: str, kinds: list[str], extra: str, key: str) -> str:
    d = DuckDraws(f"enderecos_{kind}")
    return table(
        base,
        {
            "id_endereco": key,
            "id_cliente": "id",
            "tipo_cliente": text(kind),
            "tipo_endereco": d.choice("tipo_endereco", kinds),
            "cep": d.pattern("cep", "#####-###"),
            "logradouro": d.choice("logradouro", B.STREETS),
            "numero": f"CAST({d.randint('numero', 1, 9999)} AS VARCHAR)",
            "complemento": extra,
            "bairro": d.choice("bairro", B.QUARTERS),
            "cidade": d.choice("cidade", B.CITIES),
            "uf": d.choice("uf", B.STATES),
            "pais": "'Brasil'",
            "latitude": f"CAST({d.randint('latitude', -90_000_000, 90_000_000)} AS DOUBLE) / CAST(1000000 AS DOUBLE)",
            "longitude": f"CAST({d.randint('longitude', -180_000_000, 180_000_000)} AS DOUBLE) / CAST(1000000 AS DOUBLE)",
            "flag_principal": "true",
            "dt_cadastro": d.days_back("dt_cadastro", AS_OF, 5 * YEAR),
        },
    )


APF, APJ = DuckDraws("enderecos_PF"), DuckDraws("enderecos_PJ")
HOME = f"CASE {APF.below('complemento', 4)} WHEN 0 THEN '' WHEN 1 THEN 'Apto ' || {APF.randint('Apto', 1, 300)} WHEN 2 THEN 'Casa' ELSE 'Sala ' || {APF.randint('Sala', 1, 50)} END"
WORK = f"CASE {APJ.below('complemento', 3)} WHEN 0 THEN '' WHEN 1 THEN 'Sala ' || {APJ.randint('Sala', 1, 50)} ELSE 'Andar ' || {APJ.randint('Andar', 1, 30)} END"


@register(
    "q_synth_enderecos",
    address(PERSONS, "PF", B.PERSON_ADDRESS, HOME, "id * 2") + " UNION ALL " + address(COMPANIES, "PJ", B.COMPANY_ADDRESS, WORK, "id * 2 + 1"),
    "dt_cadastro",
)
def q_synth_enderecos(t: Tables) -> DataFrame:
    return B.enderecos(persons(t), companies(t), RECIPE)


C = DuckDraws("contatos")
CONTACT_KEYS = f"SELECT id AS id_cliente, n, k, id * 4 + k AS id FROM (SELECT id, n, unnest(range(1, n + 1)) AS k FROM (SELECT id, {C.randint('n', 1, 3)} AS n FROM ({with_state(PERSONS)})))"


@register(
    "q_synth_contatos",
    table(
        CONTACT_KEYS,
        {
            "id_contato": "id",
            "id_cliente": "id_cliente",
            "tipo_cliente": "'PF'",
            "valor": f"CASE WHEN {C.flag('valor', 0.7)} THEN {C.pattern('fone', '(##) 9####-####')} ELSE lower({C.choice('mail', B.SURNAMES)}) || {C.pattern('mail#', '####')} || '@example.com' END",
            "flag_principal": "k = n",
            "flag_ativo": C.flag("flag_ativo", 0.85),
            "dt_cadastro": C.days_back("dt_cadastro", AS_OF, 5 * YEAR),
            "tipo_contato": C.choice("tipo_contato", B.CONTACT_KINDS),
        },
    ),
    "dt_cadastro",
)
def q_synth_contatos(t: Tables) -> DataFrame:
    return B.contatos(persons(t), RECIPE)


REF = f"CAST({TODAY} - to_months(CAST({B.MONTHS_OF_HISTORY} - m AS INTEGER)) AS DATE)"
SCORES = table(
    f"SELECT *, id_cliente * {B.MONTH_KEYS} + m AS id FROM ({WALK})",
    {
        "id_cliente": "id_cliente",
        "ano_mes": period(REF),
        "score": "score",
        "faixa_score": "CASE WHEN score >= 800 THEN 'A' WHEN score >= 600 THEN 'B' WHEN score >= 400 THEN 'C' WHEN score >= 200 THEN 'D' ELSE 'E' END",
        "num_consultas_mes": S.randint("num_consultas_mes", 0, 8),
        "num_dividas_ativas": S.randint("num_dividas_ativas", 0, 5),
        "valor_dividas": S.money("valor_dividas", 0, 50000),
        "flag_negativado": S.flag("flag_negativado", 0.12),
        "flag_falencia": S.flag("flag_falencia", 0.005),
        "modelo_score": S.choice("modelo_score", B.SCORE_MODELS),
        "dt_calculo": REF,
    },
)


@register("q_synth_score_historico", SCORES, "dt_calculo")
def q_synth_score_historico(t: Tables) -> DataFrame:
    return B.score_historico(persons(t), RECIPE)


Q = DuckDraws("consultas_credito")
INQUIRY_DAY = Q.days_back("dt_consulta", AS_OF, 2 * YEAR)


@register(
    "q_synth_consultas_credito",
    table(
        BY_EVENT,
        {
            "id_consulta": "id",
            "id_cliente": "id_cliente",
            "consultor": Q.choice("consultor", B.CONSULTANTS),
            "modalidade": Q.choice("modalidade", B.CREDIT_MODES),
            "finalidade": Q.choice("finalidade", B.PURPOSES),
            "valor_solicitado": Q.money("valor_solicitado", 500, 500_000),
            "score_momento": Q.randint("score_momento", 0, 1000),
            "resultado": Q.choice("resultado", B.INQUIRY_RESULTS),
            "motivo_reprovacao": Q.choice("motivo_reprovacao", B.REJECTIONS),
            "taxa_ofertada": Q.money("taxa_ofertada", 0.9, 15.5),
            "prazo_meses": Q.choice_int("prazo_meses", B.INQUIRY_TERMS),
            "dt_consulta": INQUIRY_DAY,
            "ano_mes": period(INQUIRY_DAY),
            "canal": Q.choice("canal", B.INQUIRY_CHANNELS),
        },
    ),
    "dt_consulta",
)
def q_synth_consultas_credito(t: Tables) -> DataFrame:
    return B.consultas_credito(by_event(t), RECIPE)


L = DuckDraws("limites_credito")
LIMITS = table(
    PERSONS,
    {
        "id_cliente": "id",
        "modalidade": L.choice("modalidade", B.CREDIT_MODES),
        "limite_aprovado": L.money("limite_aprovado", 500, 100_000),
        "limite_disponivel": L.money("limite_disponivel", 0, 100_000),
        "limite_utilizado": L.money("limite_utilizado", 0, 100_000),
        "taxa_juros_mensal": L.money("taxa_juros_mensal", 0.9, 12.5),
        "taxa_juros_anual": L.money("taxa_juros_anual", 11, 260),
        "prazo_max_meses": L.choice_int("prazo_max_meses", B.LIMIT_TERMS),
        "score_aprovacao": L.randint("score_aprovacao", 0, 1000),
        "dt_aprovacao": L.days_back("dt_aprovacao", AS_OF, 3 * YEAR),
        "dt_vencimento": L.days_back("dt_vencimento", AS_OF, 0, -2 * YEAR),
        "status": L.choice("status", B.LIMIT_STATUS),
        "flag_pre_aprovado": L.flag("flag_pre_aprovado", 0.3),
    },
)


@register("q_synth_limites_credito", LIMITS, "dt_aprovacao", "dt_vencimento")
def q_synth_limites_credito(t: Tables) -> DataFrame:
    return B.limites_credito(persons(t), RECIPE)


X = DuckDraws("transacoes")
X_DAY = X.days_back("dt_transacao", AS_OF, 2 * YEAR)


@register(
    "q_synth_transacoes",
    table(
        BY_ORDER,
        {
            "id_transacao": "id",
            "id_cliente": "id_cliente",
            "tipo": X.choice("tipo", B.TRANSACTION_KINDS),
            "modalidade": X.choice("modalidade", B.LOAN_MODES),
            "banco_origem": X.choice("banco_origem", B.BANKS),
            "banco_destino": X.choice("banco_destino", [*B.BANKS, None]),
            "valor": X.money("valor", 1, 50_000),
            "valor_juros": X.money("valor_juros", 0, 500),
            "valor_multa": X.money("valor_multa", 0, 200),
            "parcela_atual": X.randint("parcela_atual", 1, 60),
            "total_parcelas": X.randint("total_parcelas", 1, 60),
            "status": X.choice("status", B.TRANSACTION_STATUS),
            "canal": X.choice("canal", B.TRANSACTION_CHANNELS),
            "dt_transacao": X_DAY,
            "dt_vencimento": f"{X_DAY} + CAST({X.randint('dt_vencimento', 0, 30)} AS INTEGER)",
            "dt_pagamento": X.maybe("dt_pagamento", X_DAY, 0.2),
            "ano_mes": period(X_DAY),
            "flag_fraude": X.flag("flag_fraude", 0.005),
        },
    ),
    "dt_transacao",
    "dt_vencimento",
    "dt_pagamento",
)
def q_synth_transacoes(t: Tables) -> DataFrame:
    return B.transacoes(by_order(t), RECIPE)


K = DuckDraws("contratos")
BEGIN, TERM = K.days_back("dt_inicio", AS_OF, 5 * YEAR), K.choice_int("prazo_meses", B.CONTRACT_TERMS)


@register(
    "q_synth_contratos",
    table(
        BY_ORDER,
        {
            "id_contrato": "id",
            "id_cliente": "id_cliente",
            "numero_contrato": K.pattern("numero_contrato", "CTR-####-????-####"),
            "modalidade": K.choice("modalidade", B.LOAN_MODES),
            "banco": K.choice("banco", B.BANKS),
            "valor_contratado": K.money("valor_contratado", 1000, 500_000),
            "valor_saldo_devedor": K.money("valor_saldo_devedor", 0, 500_000),
            "taxa_juros_mensal": K.money("taxa_juros_mensal", 0.5, 15),
            "prazo_meses": TERM,
            "parcela_valor": K.money("parcela_valor", 100, 10_000),
            "parcelas_pagas": f"({K.raw('parcelas_pagas')}) % ({TERM} + 1)",
            "parcelas_em_atraso": K.randint("parcelas_em_atraso", 0, 6),
            "dt_inicio": BEGIN,
            "dt_fim_previsto": f"CAST({BEGIN} + to_months(CAST({TERM} AS INTEGER)) AS DATE)",
            "dt_liquidacao": K.maybe("dt_liquidacao", K.between("dt_liquidacao", BEGIN, AS_OF), 0.7),
            "uf": K.choice("uf", B.STATES_SHORT),
            "status": K.choice("status", B.CONTRACT_STATUS),
        },
    ),
    "dt_inicio",
    "dt_fim_previsto",
    "dt_liquidacao",
)
def q_synth_contratos(t: Tables) -> DataFrame:
    return B.contratos(by_order(t), RECIPE)


O = DuckDraws("ocorrencias")
O_DAY = O.days_back("dt_ocorrencia", AS_OF, 5 * YEAR)
DEFAULTS = table(
    BY_ORDER,
    {
        "id_ocorrencia": "id",
        "id_cliente": "id_cliente",
        "tipo_ocorrencia": O.choice("tipo_ocorrencia", B.DEFAULT_KINDS),
        "credor": O.choice("credor", B.BANKS + B.SHOPS),
        "valor_divida": O.money("valor_divida", 50, 200_000),
        "valor_atualizado": O.money("valor_atualizado", 50, 250_000),
        "dias_atraso": O.randint("dias_atraso", 1, 1800),
        "status": O.choice("status", B.DEFAULT_STATUS),
        "modalidade": O.choice("modalidade", B.LOAN_MODES + B.UTILITIES),
        "dt_ocorrencia": O_DAY,
        "dt_vencimento_orig": f"{O_DAY} - CAST({O.randint('dt_vencimento_orig', 1, 1800)} AS INTEGER)",
        "dt_liquidacao": O.maybe("dt_liquidacao", O.between("dt_liquidacao", O_DAY, AS_OF), 0.6),
        "contrato_origem": O.pattern("contrato_origem", "CTR-####-????"),
        "fase_cobranca": O.choice("fase_cobranca", B.COLLECTION_PHASES),
        "ano_mes": period(O_DAY),
    },
)


@register("q_synth_ocorrencias", DEFAULTS, "dt_ocorrencia", "dt_vencimento_orig", "dt_liquidacao")
def q_synth_ocorrencias(t: Tables) -> DataFrame:
    return B.ocorrencias(by_order(t), RECIPE)


R = DuckDraws("protestos")
R_DAY = R.days_back("dt_protesto", AS_OF, 5 * YEAR)
PROTESTS = table(
    BY_EVENT,
    {
        "id_protesto": "id",
        "id_cliente": "id_cliente",
        "cartorio": f"'CARTORIO ' || {R.pattern('cartorio', '??')} || ' OFICIO'",
        "numero_protesto": R.pattern("numero_protesto", "####/##"),
        "uf": R.choice("uf", B.STATES_SHORT),
        "cidade": R.choice("cidade", B.CITIES),
        "valor_protestado": R.money("valor_protestado", 100, 500_000),
        "credor": R.choice("credor", B.BANKS + B.PROTEST_CREDITORS),
        "status": R.choice("status", B.PROTEST_STATUS),
        "dt_protesto": R_DAY,
        "dt_cancelamento": R.maybe("dt_cancelamento", R.between("dt_cancelamento", R_DAY, AS_OF), 0.7),
        "tipo_titulo": R.choice("tipo_titulo", B.TITLES),
    },
)


@register("q_synth_protestos", PROTESTS, "dt_protesto", "dt_cancelamento")
def q_synth_protestos(t: Tables) -> DataFrame:
    return B.protestos(by_event(t), RECIPE)


A = DuckDraws("assinaturas")
A_DAY, A_STATUS = A.days_back("dt_inicio", AS_OF, 4 * YEAR), A.choice("status", B.SUBSCRIPTION_STATUS)
SUBSCRIPTIONS = table(
    BY_ORDER,
    {
        "id_assinatura": "id",
        "id_cliente": "id_cliente",
        "id_produto": A.choice_int("id_produto", B.ACTIVE_PRODUCTS),
        "plano": A.choice("plano", B.PLANS),
        "status": A_STATUS,
        "valor_pago": A.money("valor_pago", 0, 600),
        "desconto_pct": A.money("desconto_pct", 0, 40),
        "dt_inicio": A_DAY,
        "dt_fim": f"CASE WHEN {A_STATUS} <> 'ATIVA' THEN {A.between('dt_fim', A_DAY, AS_OF)} END",
        "dt_proximo_cobr": f"CASE WHEN {A_STATUS} = 'ATIVA' THEN CAST({A_DAY} + to_months(CAST({A.randint('dt_proximo_cobr', 1, 3)} AS INTEGER)) AS DATE) END",
        "canal_venda": A.choice("canal_venda", B.SALES_CHANNELS),
        "cupom": A.choice("cupom", B.COUPONS),
        "flag_trial": f"{A_STATUS} = 'TRIAL'",
        "motivo_cancel": f"CASE WHEN {A_STATUS} = 'CANCELADA' THEN {A.choice('motivo_cancel', B.CANCEL_REASONS)} ELSE '' END",
    },
)


@register("q_synth_assinaturas", SUBSCRIPTIONS, "dt_inicio", "dt_fim", "dt_proximo_cobr")
def q_synth_assinaturas(t: Tables) -> DataFrame:
    return B.assinaturas(by_order(t), RECIPE)


PRODUCT_ROWS = ", ".join(f"({p[0]}, '{p[1]}', '{p[2]}', '{p[3]}', CAST({p[4]} AS DOUBLE), '{p[5]}', {str(p[6]).lower()})" for p in B.PRODUCTS)
CATALOGUE = f"SELECT * FROM (VALUES {PRODUCT_ROWS}) p(id_produto, codigo, nome, categoria, preco_mensal, plataforma, ativo)"


@register(
    "q_synth_catalogo_produtos",
    f"""SELECT p.*, coalesce(n, 0) AS n_assinaturas FROM ({CATALOGUE}) p
LEFT JOIN (SELECT id_produto, count(*) AS n FROM ({SUBSCRIPTIONS}) GROUP BY 1) s ON p.id_produto = s.id_produto""",
)
def q_synth_catalogo_produtos(t: Tables) -> DataFrame:
    """The product catalogue with the subscriptions that refer to it."""
    used = B.assinaturas(by_order(t), RECIPE).groupBy("id_produto").agg(F.count("*").alias("n_assinaturas"))
    joined = B.catalogo_produtos(t.spark).join(used, "id_produto", "left")
    return joined.withColumn("n_assinaturas", F.coalesce("n_assinaturas", F.lit(0)))


U = DuckDraws("uso_produto")
U_DAY = U.days_back("dt_evento", AS_OF, YEAR)


@register(
    "q_synth_uso_produto",
    table(
        BY_EVENT,
        {
            "id_uso": "id",
            "id_cliente": "id_cliente",
            "id_produto": U.choice_int("id_produto", B.ACTIVE_PRODUCTS),
            "tipo_evento": U.choice("tipo_evento", B.USAGE_KINDS),
            "dispositivo": U.choice("dispositivo", B.DEVICES),
            "duracao_seg": U.randint("duracao_seg", 1, 3600),
            "dt_evento": U_DAY,
            "ano_mes": period(U_DAY),
            "sucesso": U.flag("sucesso", 0.95),
            "codigo_erro": f"CASE WHEN {U.flag('codigo_erro?', 0.95)} THEN '' ELSE {U.choice('codigo_erro', B.ERROR_CODES)} END",
        },
    ),
    "dt_evento",
)
def q_synth_uso_produto(t: Tables) -> DataFrame:
    return B.uso_produto(by_event(t), RECIPE)


V = DuckDraws("precos_historico")
PRICE_KEYS = f"""SELECT p_partkey AS id_produto, p_brand AS codigo, CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
unnest(range(0, {B.MONTHS_OF_PRICES})) AS m FROM part"""
PRICE = f"greatest((cents * ({V.randint('variacao', -500, 1000)} + 10000) + 5000) // 10000, 0)"


@register(
    "q_price_history",
    table(
        f"SELECT *, id_produto * {B.MONTH_KEYS} + m AS id FROM ({PRICE_KEYS})",
        {
            "id_produto": "id_produto",
            "codigo_produto": "codigo",
            "ano_mes": period(f"CAST({TODAY} - to_months(CAST(m AS INTEGER)) AS DATE)"),
            "preco_mensal": f"CAST({PRICE} AS DOUBLE) / CAST(100 AS DOUBLE)",
            "preco_anual": f"CAST({PRICE} * 10 AS DOUBLE) / CAST(100 AS DOUBLE)",
            "moeda": "'BRL'",
            "motivo_alteracao": V.choice("motivo_alteracao", B.PRICE_REASONS),
        },
    ),
)
def q_price_history(t: Tables) -> DataFrame:
    products = t.part.select(
        F.col("p_partkey").alias("id_produto"), F.col("p_brand").alias("codigo"), F.col("p_retailprice").alias("preco_mensal")
    )
    return B.precos_historico(products, RECIPE)


# ---------------------------------------------------------------- views over them


@register(
    "q_vw_clientes_ativos",
    f"""SELECT 'PF' AS tipo_cliente, id_cliente, cpf AS documento, nome AS razao_nome, score_bureau, faixa_score, uf_nascimento AS uf,
renda_mensal AS capacidade_financeira, dt_cadastro FROM ({PF}) WHERE status = 'ATIVO'
UNION ALL SELECT 'PJ', id_empresa, cnpj, razao_social, score_bureau, faixa_score, uf_sede, faturamento_anual, dt_cadastro FROM ({PJ}) WHERE status = 'ATIVO'""",
    "dt_cadastro",
)
def q_vw_clientes_ativos(t: Tables) -> DataFrame:
    return analytics.active_parties(B.clientes_pf(persons(t), RECIPE), B.clientes_pj(companies(t), RECIPE))


@register(
    "q_vw_score_atual",
    f"""SELECT s.id_cliente, s.score, s.faixa_score, s.num_consultas_mes, s.num_dividas_ativas, s.valor_dividas, s.flag_negativado, s.dt_calculo,
l.limite_aprovado, l.limite_disponivel, l.taxa_juros_mensal
FROM (SELECT *, rank() OVER (PARTITION BY id_cliente ORDER BY ano_mes DESC) AS newest FROM ({SCORES})) s
LEFT JOIN (SELECT * FROM ({LIMITS}) WHERE status = 'ATIVO') l USING (id_cliente) WHERE newest = 1""",
    "dt_calculo",
)
def q_vw_score_atual(t: Tables) -> DataFrame:
    # The history is read twice, so it is stored once, as it would be in a bureau.
    history = scratch.materialize(B.score_historico(persons(t), RECIPE), "scores")
    return analytics.current_score(history, B.limites_credito(persons(t), RECIPE))


@register(
    "q_vw_inadimplentes_ativos",
    f"""WITH debts AS (SELECT id_cliente, count(id_ocorrencia) AS qtd_ocorrencias, count(DISTINCT credor) AS qtd_credores, max(dias_atraso) AS max_dias_atraso,
  sum(CAST(valor_atualizado AS DECIMAL(18,2))) AS total_divida, min(dt_ocorrencia) AS primeira_ocorrencia, max(dt_ocorrencia) AS ultima_ocorrencia
  FROM ({DEFAULTS}) WHERE status = 'ATIVA' GROUP BY 1),
notes AS (SELECT id_cliente, count(*) AS n, sum(CAST(valor_protestado AS DECIMAL(18,2))) AS v FROM ({PROTESTS}) WHERE status = 'ATIVO' GROUP BY 1)
SELECT debts.*, coalesce(n, 0) AS qtd_protestos, coalesce(v, 0) AS total_protestado FROM debts LEFT JOIN notes USING (id_cliente)""",
    "total_divida",
    "total_protestado",
    "primeira_ocorrencia",
    "ultima_ocorrencia",
)
def q_vw_inadimplentes_ativos(t: Tables) -> DataFrame:
    return analytics.open_defaults(B.ocorrencias(by_order(t), RECIPE), B.protestos(by_event(t), RECIPE))
