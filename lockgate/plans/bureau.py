"""Synthetic credit-bureau tables of any size.

Every table is a projection of a frame of row keys: ``spark.range`` for a given number of rows, or the
keys of a table that is there. Columns are pure functions of (seed, table, column, key), so there is no
shuffle, nothing is built on the driver, and a lost task is made again with the same rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lockgate import schemas
from lockgate.functions import documents
from lockgate.functions.draws import Draws, period, with_state
from lockgate.sources import tables

# Domains of the generated columns.
STATES = [
    "SP", "RJ", "MG", "RS", "PR", "SC", "BA", "GO", "PE", "CE", "AM", "PA", "MT", "MS",
    "ES", "RN", "PB", "MA", "PI", "AL", "SE", "RO", "TO", "AC", "AP", "RR", "DF",
]
STATES_SHORT = ["SP", "RJ", "MG", "RS", "PR", "SC", "BA", "GO", "PE", "CE", "AM", "PA", "MT", "MS", "ES"]
BANDS = ["A", "B", "C", "D", "E"]
CLIENT_STATUS = ["ATIVO", "INATIVO", "SUSPENSO", "BLOQUEADO"]
GENDERS = ["M", "F", "N"]
MARITAL = ["SOLTEIRO", "CASADO", "DIVORCIADO", "VIUVO", "UNIAO_ESTAVEL"]
SCHOOLING = ["FUNDAMENTAL", "MEDIO", "SUPERIOR", "POS_GRADUACAO", "MESTRADO", "DOUTORADO"]
PERSON_CHANNELS = ["WEB", "APP", "PARCEIRO", "PRESENCIAL", "API"]
COMPANY_CHANNELS = ["WEB", "APP", "PARCEIRO", "API"]
ORIGINS = ["ORGANICO", "INDICACAO", "CAMPANHA", "COBRANCA"]
COMPANY_SIZES = ["MEI", "ME", "EPP", "MEDIO", "GRANDE"]
SECTORS = [
    "TECNOLOGIA", "VAREJO", "INDUSTRIA", "SERVICOS", "SAUDE",
    "EDUCACAO", "FINANCEIRO", "AGRONEGOCIO", "CONSTRUCAO", "TRANSPORTE",
]
TAX_STATUS = ["ATIVA", "INAPTA", "SUSPENSA", "BAIXADA", "NULA"]
PERSON_ADDRESS = ["RESIDENCIAL", "COMERCIAL", "COBRANCA", "ENTREGA"]
COMPANY_ADDRESS = ["SEDE", "FILIAL", "COBRANCA", "ENTREGA"]
CONTACT_KINDS = ["CELULAR", "RESIDENCIAL", "COMERCIAL", "EMAIL", "WHATSAPP"]
SCORE_MODELS = ["MODELO_V1", "MODELO_V2", "MODELO_V3"]
CREDIT_MODES = [
    "CARTAO_CREDITO", "CREDITO_PESSOAL", "FINANCIAMENTO_VEICULO", "CREDITO_IMOBILIARIO",
    "CHEQUE_ESPECIAL", "CONSIGNADO", "CDC", "MICROCRÉDITO",
]
PURPOSES = ["CONSUMO", "INVESTIMENTO", "CAPITAL_GIRO", "REFINANCIAMENTO", "EMERGENCIA", "EDUCACAO", "VIAGEM", "REFORMA"]
CONSULTANTS = ["BANCO_A", "BANCO_B", "FINTECH_A", "FINTECH_B", "VAREJO_A", "VAREJO_B", "TELCO", "SEGURADORA", "LOCADORA"]
INQUIRY_RESULTS = ["APROVADO", "REPROVADO", "PENDENTE", "CANCELADO"]
REJECTIONS = ["", "SCORE_BAIXO", "RENDA_INSUFICIENTE", "NEGATIVADO", "DOCUMENTACAO", "POLITICA_INTERNA"]
INQUIRY_TERMS = [6, 12, 18, 24, 36, 48, 60, 72, 84]
INQUIRY_CHANNELS = ["APP", "WEB", "PDV", "TELEFONE", "API"]
LIMIT_TERMS = [12, 24, 36, 48, 60, 72, 84]
LIMIT_STATUS = ["ATIVO", "SUSPENSO", "CANCELADO", "VENCIDO"]
LOAN_MODES = ["CARTAO_CREDITO", "CREDITO_PESSOAL", "FINANCIAMENTO_VEICULO", "CREDITO_IMOBILIARIO", "CONSIGNADO", "CDC"]
BANKS = ["BANCO_DO_BRASIL", "CAIXA", "ITAU", "BRADESCO", "SANTANDER", "NUBANK", "INTER", "C6", "SICOOB", "SICREDI"]
TRANSACTION_KINDS = ["COMPRA", "SAQUE", "TRANSFERENCIA", "PIX", "PAGAMENTO_BOLETO", "ESTORNO", "TARIFA", "JUROS", "IOF"]
TRANSACTION_STATUS = ["PAGO", "PENDENTE", "ATRASADO", "CANCELADO", "ESTORNADO"]
TRANSACTION_CHANNELS = ["APP", "WEB", "PDV", "ATM", "TEF"]
CONTRACT_TERMS = [6, 12, 18, 24, 36, 48, 60, 72, 84, 120]
CONTRACT_STATUS = ["ATIVO", "LIQUIDADO", "INADIMPLENTE", "RENEGOCIADO", "CANCELADO"]
DEFAULT_KINDS = ["ATRASO", "NEGATIVACAO", "PROTESTO", "ACAO_JUDICIAL", "FALENCIA", "CONCORDATA"]
SHOPS = ["LOJA_A", "LOJA_B", "CONCESSIONARIA", "PLANO_SAUDE", "ESCOLA"]
DEFAULT_STATUS = ["ATIVA", "LIQUIDADA", "PRESCRITA", "CONTESTADA", "SUSPENSA"]
UTILITIES = ["AGUA", "LUZ", "TELEFONIA", "CONDOMINIO", "ALUGUEL"]
COLLECTION_PHASES = ["PREVENTIVA", "ADMINISTRATIVA", "JURIDICA", "NEGATIVACAO", "PRESCRICAO"]
PROTEST_CREDITORS = ["LOJA_A", "FORNECEDOR_A"]
PROTEST_STATUS = ["ATIVO", "CANCELADO", "PAGO", "PRESCRITO"]
TITLES = ["NOTA_PROMISSORIA", "DUPLICATA", "CHEQUE", "LETRA_CAMBIO", "CCB"]
PLANS = ["MENSAL", "TRIMESTRAL", "SEMESTRAL", "ANUAL"]
SUBSCRIPTION_STATUS = ["ATIVA", "CANCELADA", "SUSPENSA", "TRIAL"]
SALES_CHANNELS = ["APP", "WEB", "PARCEIRO", "TELEVENDAS", "PDV"]
COUPONS = ["", "PROMO10", "DESCONTO20", "FIDELIDADE", "PARCEIRO15"]
CANCEL_REASONS = ["PRECO", "CONCORRENCIA", "NAO_USA", "INSATISFACAO", "FINANCEIRO", "PORTABILIDADE"]
USAGE_KINDS = ["LOGIN", "CONSULTA", "DOWNLOAD", "COMPARTILHAMENTO", "ALERTA", "CONTESTACAO"]
DEVICES = ["ANDROID", "IOS", "WEB_DESKTOP", "WEB_MOBILE", "API"]
ERROR_CODES = ["ERR_001", "ERR_002", "TIMEOUT", "UNAUTHORIZED"]
PRICE_REASONS = ["REAJUSTE_ANUAL", "PROMOCAO", "CORRECAO", "LANCAMENTO", ""]

# The product catalogue (id, code, name, category, monthly price, platform, active).
PRODUCTS = [
    (1, "SCPF001", "Score PF", "SCORE", 9.90, "B2C", True),
    (2, "SCPJ001", "Score PJ", "SCORE", 29.90, "B2B", True),
    (3, "MON001", "Monitora PF", "MONITORAMENTO", 14.90, "B2C", True),
    (4, "MON002", "Monitora Empresa", "MONITORAMENTO", 49.90, "B2B", True),
    (5, "REL001", "Relatório Completo PF", "RELATORIO", 0.0, "B2C", True),
    (6, "REL002", "Relatório Completo PJ", "RELATORIO", 0.0, "B2B", True),
    (7, "NEG001", "Negativação Digital", "COBRANCA", 199.90, "B2B", True),
    (8, "BOL001", "Boleto", "COBRANCA", 49.90, "B2B", True),
    (9, "CAD001", "Cadastro Positivo", "CADASTRO", 0.0, "B2C", True),
    (10, "API001", "API Consulta Score", "API", 299.0, "B2B", True),
    (11, "API002", "API Dados Cadastrais", "API", 499.0, "B2B", True),
    (12, "ANT001", "Antifraude Basico", "ANTIFRAUDE", 149.90, "B2B", True),
    (13, "ANT002", "Antifraude Premium", "ANTIFRAUDE", 499.90, "B2B", True),
    (14, "OLD001", "Score Legado v1", "SCORE", 4.90, "B2C", False),
    (15, "OLD002", "Consulta Basica Legado", "RELATORIO", 0.0, "B2C", False),
]
PRODUCT_SCHEMA = schemas.struct(
    "id_produto bigint, codigo string, nome string, categoria string, preco_mensal double, plataforma string, ativo boolean"
)
ACTIVE_PRODUCTS = [p[0] for p in PRODUCTS if p[-1]]

# Words for names and places.
MALE = ["Antonio", "Bruno", "Carlos", "Daniel", "Eduardo", "Felipe", "Gustavo", "Henrique", "Joao", "Lucas"]
FEMALE = ["Ana", "Beatriz", "Camila", "Daniela", "Fernanda", "Gabriela", "Helena", "Juliana", "Larissa", "Maria"]
SURNAMES = ["Almeida", "Barbosa", "Cardoso", "Costa", "Ferreira", "Gomes", "Lima", "Moreira", "Oliveira", "Pereira", "Rocha", "Souza"]
FIRMS = ["Comercial", "Industrial", "Servicos", "Logistica", "Alimentos", "Tecnologia"]
SUFFIXES = ["Ltda", "S.A.", "ME", "e Filhos"]
STREETS = ["Rua das Flores", "Avenida Central", "Travessa do Sol", "Alameda Santos", "Rua do Porto", "Praca da Matriz"]
QUARTERS = ["Centro", "Jardim America", "Vila Nova", "Boa Vista", "Santo Antonio"]
CITIES = ["Sao Paulo", "Campinas", "Curitiba", "Salvador", "Recife", "Manaus", "Goiania", "Fortaleza"]

YEAR = 365
MONTHS_OF_HISTORY = 24
MONTHS_OF_PRICES = 48
#: Keys of monthly rows are client * MONTH_KEYS + month; a history has at most this many months.
MONTH_KEYS = 1024


@dataclass
class Recipe:
    """What all tables share. ``clients`` bounds the client keys drawn where a key frame brings none."""

    as_of: dt.date
    clients: int = 10_000
    seed: int = 42


def keys(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    return spark.range(1, rows + 1, 1, partitions)


def _start(base: DataFrame, table: str, recipe: Recipe) -> tuple[DataFrame, Draws, Column]:
    """State, draws and client key for a frame with ``id`` and, if it has one, ``id_cliente``."""
    draws = Draws(table)
    client = F.col("id_cliente") if "id_cliente" in base.columns else draws.randint("id_cliente", 1, recipe.clients)
    return with_state(base, "id", recipe.seed), draws, client.cast("bigint")


def _full_name(d: Draws, column: str, first: list[str]) -> Column:
    return F.concat_ws(" ", d.choice(f"{column}.1", first), d.choice(f"{column}.2", SURNAMES))


def _company_name(d: Draws, column: str) -> Column:
    return F.concat_ws(
        " ", d.choice(f"{column}.1", SURNAMES), d.choice(f"{column}.2", FIRMS), d.choice(f"{column}.3", SUFFIXES)
    )


def clientes_pf(base: DataFrame, recipe: Recipe) -> DataFrame:
    df, d, _ = _start(base, "clientes_pf", recipe)
    df = documents.with_cpf(df, "cpf", d.below("cpf", 10**9))
    day = recipe.as_of
    return df.select(
        F.col("id").alias("id_cliente"),
        "cpf",
        _full_name(d, "nome", MALE + FEMALE).alias("nome"),
        _full_name(d, "nome_mae", FEMALE).alias("nome_mae"),
        d.days_back("data_nascimento", day, 85 * YEAR, 18 * YEAR).alias("data_nascimento"),
        d.choice("genero", GENDERS).alias("genero"),
        F.lit("Brasileira").alias("nacionalidade"),
        d.choice("estado_civil", MARITAL).alias("estado_civil"),
        d.choice("escolaridade", SCHOOLING).alias("escolaridade"),
        d.money("renda_mensal", 1320.0, 35000.0).alias("renda_mensal"),
        d.randint("score_bureau", 0, 1000).alias("score_bureau"),
        d.choice("faixa_score", BANDS).alias("faixa_score"),
        d.choice("status", CLIENT_STATUS).alias("status"),
        d.choice("uf_nascimento", STATES).alias("uf_nascimento"),
        d.days_back("dt_cadastro", day, 10 * YEAR).alias("dt_cadastro"),
        d.days_back("dt_atualizacao", day, YEAR).alias("dt_atualizacao"),
        d.flag("flag_pep", 0.02).alias("flag_pep"),
        d.flag("flag_obito", 0.005).alias("flag_obito"),
        d.choice("canal_cadastro", PERSON_CHANNELS).alias("canal_cadastro"),
        d.choice("origem", ORIGINS).alias("origem"),
    )


def clientes_pj(base: DataFrame, recipe: Recipe) -> DataFrame:
    df, d, _ = _start(base, "clientes_pj", recipe)
    df = documents.with_cnpj(df, "cnpj", d.below("cnpj", 10**12))
    day = recipe.as_of
    activity = F.concat(
        d.randint("cnae.1", 1000, 9999), F.lit("-"), d.randint("cnae.2", 1, 9), F.lit("/"), d.randint("cnae.3", 10, 99)
    )
    return df.select(
        F.col("id").alias("id_empresa"),
        "cnpj",
        _company_name(d, "razao_social").alias("razao_social"),
        _company_name(d, "nome_fantasia").alias("nome_fantasia"),
        d.choice("porte", COMPANY_SIZES).alias("porte"),
        d.choice("setor", SECTORS).alias("setor"),
        activity.alias("cnae_principal"),
        d.money("faturamento_anual", 81000.0, 300_000_000.0).alias("faturamento_anual"),
        d.randint("num_funcionarios", 1, 5000).alias("num_funcionarios"),
        d.randint("score_bureau", 0, 1000).alias("score_bureau"),
        d.choice("faixa_score", BANDS).alias("faixa_score"),
        d.choice("status", CLIENT_STATUS).alias("status"),
        d.choice("uf_sede", STATES).alias("uf_sede"),
        d.days_back("dt_abertura", day, 30 * YEAR, YEAR).alias("dt_abertura"),
        d.days_back("dt_cadastro", day, 10 * YEAR).alias("dt_cadastro"),
        d.days_back("dt_atualizacao", day, YEAR).alias("dt_atualizacao"),
        d.money("capital_social", 1000.0, 10_000_000.0).alias("capital_social"),
        d.flag("optante_simples", 0.4).alias("optante_simples"),
        d.flag("flag_mei", 0.2).alias("flag_mei"),
        d.choice("situacao_receita", TAX_STATUS).alias("situacao_receita"),
        d.choice("canal_cadastro", COMPANY_CHANNELS).alias("canal_cadastro"),
    )


def _address(base: DataFrame, recipe: Recipe, kind: str, address_kinds: list[str], extra: Column, key: Column) -> DataFrame:
    df, d, _ = _start(base, f"enderecos_{kind}", recipe)
    return df.select(
        key.alias("id_endereco"),
        F.col("id").alias("id_cliente"),
        F.lit(kind).alias("tipo_cliente"),
        d.choice("tipo_endereco", address_kinds).alias("tipo_endereco"),
        d.pattern("cep", "#####-###").alias("cep"),
        d.choice("logradouro", STREETS).alias("logradouro"),
        d.randint("numero", 1, 9999).cast("string").alias("numero"),
        extra.alias("complemento"),
        d.choice("bairro", QUARTERS).alias("bairro"),
        d.choice("cidade", CITIES).alias("cidade"),
        d.choice("uf", STATES).alias("uf"),
        F.lit("Brasil").alias("pais"),
        (d.randint("latitude", -90_000_000, 90_000_000) / F.lit(1_000_000.0)).alias("latitude"),
        (d.randint("longitude", -180_000_000, 180_000_000) / F.lit(1_000_000.0)).alias("longitude"),
        F.lit(True).alias("flag_principal"),
        d.days_back("dt_cadastro", recipe.as_of, 5 * YEAR).alias("dt_cadastro"),
    )


def enderecos(persons: DataFrame, companies: DataFrame, recipe: Recipe) -> DataFrame:
    """One address per client; person addresses have even keys, company addresses odd ones."""
    pf, pj = Draws("enderecos_PF"), Draws("enderecos_PJ")

    def numbered(d: Draws, word: str, most: int) -> Column:
        return F.concat(F.lit(f"{word} "), d.randint(word, 1, most))

    pick = pf.below("complemento", 4)
    at_home = (
        F.when(pick == 0, "").when(pick == 1, numbered(pf, "Apto", 300)).when(pick == 2, "Casa").otherwise(numbered(pf, "Sala", 50))
    )
    pick = pj.below("complemento", 3)
    at_work = F.when(pick == 0, "").when(pick == 1, numbered(pj, "Sala", 50)).otherwise(numbered(pj, "Andar", 30))
    return _address(persons, recipe, "PF", PERSON_ADDRESS, at_home, F.col("id") * 2).unionByName(
        _address(companies, recipe, "PJ", COMPANY_ADDRESS, at_work, F.col("id") * 2 + 1)
    )


def contatos(persons: DataFrame, recipe: Recipe) -> DataFrame:
    """One to three contacts per person, exactly one of them the main one."""
    d = Draws("contatos")
    parents = with_state(persons, "id", recipe.seed).withColumn("n", d.randint("n", 1, 3).cast("int"))
    rows = parents.select(F.col("id").alias("id_cliente"), "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"))
    df = with_state(rows.withColumn("id", F.col("id_cliente") * 4 + F.col("k")), "id", recipe.seed)
    phone = d.pattern("fone", "(##) 9####-####")
    mail = F.concat(F.lower(d.choice("mail", SURNAMES)), d.pattern("mail#", "####"), F.lit("@example.com"))
    return df.select(
        F.col("id").alias("id_contato"),
        "id_cliente",
        F.lit("PF").alias("tipo_cliente"),
        F.when(d.flag("valor", 0.7), phone).otherwise(mail).alias("valor"),
        (F.col("k") == F.col("n")).alias("flag_principal"),
        d.flag("flag_ativo", 0.85).alias("flag_ativo"),
        d.days_back("dt_cadastro", recipe.as_of, 5 * YEAR).alias("dt_cadastro"),
        d.choice("tipo_contato", CONTACT_KINDS).alias("tipo_contato"),
    )


def score_walk(months: int = MONTHS_OF_HISTORY) -> Column:
    """Array of monthly scores: start 200..900, steps of -40..40, held within 0..1000.

    The bounds make each score depend on the one before, so the walk folds over the months of one row.
    """
    d = Draws("score_historico")
    start = f"array({d.randint_sql('start', 200, 900)})"
    now = f"least(greatest(element_at(path, -1) + {d.randint_sql('walk', -40, 40, 'm')}, 0L), 1000L)"
    return F.expr(f"slice(aggregate(sequence(1, {months}), {start}, (path, m) -> concat(path, array({now}))), 2, {months})")


def score_letter(score: Column) -> Column:
    return F.when(score >= 800, "A").when(score >= 600, "B").when(score >= 400, "C").when(score >= 200, "D").otherwise("E")


def score_historico(persons: DataFrame, recipe: Recipe, months: int = MONTHS_OF_HISTORY) -> DataFrame:
    if not 0 < months <= MONTH_KEYS:
        raise ValueError(f"a history has 1 to {MONTH_KEYS} months")
    d = Draws("score_historico")
    walks = with_state(persons, "id", recipe.seed).select(
        F.col("id").alias("id_cliente"), F.posexplode(score_walk(months)).alias("m", "score")
    )
    df = with_state(walks.withColumn("id", F.col("id_cliente") * MONTH_KEYS + F.col("m")), "id", recipe.seed)
    ref = F.add_months(F.lit(recipe.as_of), F.col("m") - months)
    return df.select(
        "id_cliente",
        period(ref).alias("ano_mes"),
        "score",
        score_letter(F.col("score")).alias("faixa_score"),
        d.randint("num_consultas_mes", 0, 8).alias("num_consultas_mes"),
        d.randint("num_dividas_ativas", 0, 5).alias("num_dividas_ativas"),
        d.money("valor_dividas", 0, 50000).alias("valor_dividas"),
        d.flag("flag_negativado", 0.12).alias("flag_negativado"),
        d.flag("flag_falencia", 0.005).alias("flag_falencia"),
        d.choice("modelo_score", SCORE_MODELS).alias("modelo_score"),
        ref.alias("dt_calculo"),
    )


def consultas_credito(base: DataFrame, recipe: Recipe) -> DataFrame:
    df, d, client = _start(base, "consultas_credito", recipe)
    day = d.days_back("dt_consulta", recipe.as_of, 2 * YEAR)
    return df.select(
        F.col("id").alias("id_consulta"),
        client.alias("id_cliente"),
        d.choice("consultor", CONSULTANTS).alias("consultor"),
        d.choice("modalidade", CREDIT_MODES).alias("modalidade"),
        d.choice("finalidade", PURPOSES).alias("finalidade"),
        d.money("valor_solicitado", 500.0, 500_000.0).alias("valor_solicitado"),
        d.randint("score_momento", 0, 1000).alias("score_momento"),
        d.choice("resultado", INQUIRY_RESULTS).alias("resultado"),
        d.choice("motivo_reprovacao", REJECTIONS).alias("motivo_reprovacao"),
        d.money("taxa_ofertada", 0.9, 15.5).alias("taxa_ofertada"),
        d.choice_int("prazo_meses", INQUIRY_TERMS).alias("prazo_meses"),
        day.alias("dt_consulta"),
        period(day).alias("ano_mes"),
        d.choice("canal", INQUIRY_CHANNELS).alias("canal"),
    )


def limites_credito(persons: DataFrame, recipe: Recipe) -> DataFrame:
    df, d, _ = _start(persons, "limites_credito", recipe)
    return df.select(
        F.col("id").alias("id_cliente"),
        d.choice("modalidade", CREDIT_MODES).alias("modalidade"),
        d.money("limite_aprovado", 500.0, 100_000.0).alias("limite_aprovado"),
        d.money("limite_disponivel", 0.0, 100_000.0).alias("limite_disponivel"),
        d.money("limite_utilizado", 0.0, 100_000.0).alias("limite_utilizado"),
        d.money("taxa_juros_mensal", 0.9, 12.5).alias("taxa_juros_mensal"),
        d.money("taxa_juros_anual", 11.0, 260.0).alias("taxa_juros_anual"),
        d.choice_int("prazo_max_meses", LIMIT_TERMS).alias("prazo_max_meses"),
        d.randint("score_aprovacao", 0, 1000).alias("score_aprovacao"),
        d.days_back("dt_aprovacao", recipe.as_of, 3 * YEAR).alias("dt_aprovacao"),
        d.days_back("dt_vencimento", recipe.as_of, 0, -2 * YEAR).alias("dt_vencimento"),
        d.choice("status", LIMIT_STATUS).alias("status"),
        d.flag("flag_pre_aprovado", 0.3).alias("flag_pre_aprovado"),
    )


def transacoes(base: DataFrame, recipe: Recipe) -> DataFrame:
    df, d, client = _start(base, "transacoes", recipe)
    day = d.days_back("dt_transacao", recipe.as_of, 2 * YEAR)
    return df.select(
        F.col("id").alias("id_transacao"),
        client.alias("id_cliente"),
        d.choice("tipo", TRANSACTION_KINDS).alias("tipo"),
        d.choice("modalidade", LOAN_MODES).alias("modalidade"),
        d.choice("banco_origem", BANKS).alias("banco_origem"),
        d.choice("banco_destino", [*BANKS, None]).alias("banco_destino"),
        d.money("valor", 1.0, 50_000.0).alias("valor"),
        d.money("valor_juros", 0.0, 500.0).alias("valor_juros"),
        d.money("valor_multa", 0.0, 200.0).alias("valor_multa"),
        d.randint("parcela_atual", 1, 60).alias("parcela_atual"),
        d.randint("total_parcelas", 1, 60).alias("total_parcelas"),
        d.choice("status", TRANSACTION_STATUS).alias("status"),
        d.choice("canal", TRANSACTION_CHANNELS).alias("canal"),
        day.alias("dt_transacao"),
        F.date_add(day, d.randint("dt_vencimento", 0, 30).cast("int")).alias("dt_vencimento"),
        d.maybe("dt_pagamento", day, 0.2).alias("dt_pagamento"),
        period(day).alias("ano_mes"),
        d.flag("flag_fraude", 0.005).alias("flag_fraude"),
    )


def contratos(base: DataFrame, recipe: Recipe) -> DataFrame:
    df, d, client = _start(base, "contratos", recipe)
    begin = d.days_back("dt_inicio", recipe.as_of, 5 * YEAR)
    term = d.choice_int("prazo_meses", CONTRACT_TERMS)
    return df.select(
        F.col("id").alias("id_contrato"),
        client.alias("id_cliente"),
        d.pattern("numero_contrato", "CTR-####-????-####").alias("numero_contrato"),
        d.choice("modalidade", LOAN_MODES).alias("modalidade"),
        d.choice("banco", BANKS).alias("banco"),
        d.money("valor_contratado", 1_000.0, 500_000.0).alias("valor_contratado"),
        d.money("valor_saldo_devedor", 0.0, 500_000.0).alias("valor_saldo_devedor"),
        d.money("taxa_juros_mensal", 0.5, 15.0).alias("taxa_juros_mensal"),
        term.alias("prazo_meses"),
        d.money("parcela_valor", 100.0, 10_000.0).alias("parcela_valor"),
        (d.raw("parcelas_pagas") % (term + 1)).alias("parcelas_pagas"),
        d.randint("parcelas_em_atraso", 0, 6).alias("parcelas_em_atraso"),
        begin.alias("dt_inicio"),
        F.add_months(begin, term.cast("int")).alias("dt_fim_previsto"),
        d.maybe("dt_liquidacao", d.between("dt_liquidacao", begin, recipe.as_of), 0.7).alias("dt_liquidacao"),
        d.choice("uf", STATES_SHORT).alias("uf"),
        d.choice("status", CONTRACT_STATUS).alias("status"),
    )


def ocorrencias(base: DataFrame, recipe: Recipe) -> DataFrame:
    df, d, client = _start(base, "ocorrencias", recipe)
    day = d.days_back("dt_ocorrencia", recipe.as_of, 5 * YEAR)
    return df.select(
        F.col("id").alias("id_ocorrencia"),
        client.alias("id_cliente"),
        d.choice("tipo_ocorrencia", DEFAULT_KINDS).alias("tipo_ocorrencia"),
        d.choice("credor", BANKS + SHOPS).alias("credor"),
        d.money("valor_divida", 50.0, 200_000.0).alias("valor_divida"),
        d.money("valor_atualizado", 50.0, 250_000.0).alias("valor_atualizado"),
        d.randint("dias_atraso", 1, 1800).alias("dias_atraso"),
        d.choice("status", DEFAULT_STATUS).alias("status"),
        d.choice("modalidade", LOAN_MODES + UTILITIES).alias("modalidade"),
        day.alias("dt_ocorrencia"),
        F.date_sub(day, d.randint("dt_vencimento_orig", 1, 1800).cast("int")).alias("dt_vencimento_orig"),
        d.maybe("dt_liquidacao", d.between("dt_liquidacao", day, recipe.as_of), 0.6).alias("dt_liquidacao"),
        d.pattern("contrato_origem", "CTR-####-????").alias("contrato_origem"),
        d.choice("fase_cobranca", COLLECTION_PHASES).alias("fase_cobranca"),
        period(day).alias("ano_mes"),
    )


def protestos(base: DataFrame, recipe: Recipe) -> DataFrame:
    df, d, client = _start(base, "protestos", recipe)
    day = d.days_back("dt_protesto", recipe.as_of, 5 * YEAR)
    return df.select(
        F.col("id").alias("id_protesto"),
        client.alias("id_cliente"),
        F.concat(F.lit("CARTORIO "), d.pattern("cartorio", "??"), F.lit(" OFICIO")).alias("cartorio"),
        d.pattern("numero_protesto", "####/##").alias("numero_protesto"),
        d.choice("uf", STATES_SHORT).alias("uf"),
        d.choice("cidade", CITIES).alias("cidade"),
        d.money("valor_protestado", 100.0, 500_000.0).alias("valor_protestado"),
        d.choice("credor", BANKS + PROTEST_CREDITORS).alias("credor"),
        d.choice("status", PROTEST_STATUS).alias("status"),
        day.alias("dt_protesto"),
        d.maybe("dt_cancelamento", d.between("dt_cancelamento", day, recipe.as_of), 0.7).alias("dt_cancelamento"),
        d.choice("tipo_titulo", TITLES).alias("tipo_titulo"),
    )


def catalogo_produtos(spark: SparkSession) -> DataFrame:
    return tables.frame(spark, PRODUCTS, PRODUCT_SCHEMA)


def assinaturas(base: DataFrame, recipe: Recipe) -> DataFrame:
    df, d, client = _start(base, "assinaturas", recipe)
    begin = d.days_back("dt_inicio", recipe.as_of, 4 * YEAR)
    status = d.choice("status", SUBSCRIPTION_STATUS)
    next_bill = F.add_months(begin, d.randint("dt_proximo_cobr", 1, 3).cast("int"))
    return df.select(
        F.col("id").alias("id_assinatura"),
        client.alias("id_cliente"),
        d.choice_int("id_produto", ACTIVE_PRODUCTS).alias("id_produto"),
        d.choice("plano", PLANS).alias("plano"),
        status.alias("status"),
        d.money("valor_pago", 0.0, 600.0).alias("valor_pago"),
        d.money("desconto_pct", 0.0, 40.0).alias("desconto_pct"),
        begin.alias("dt_inicio"),
        F.when(status != "ATIVA", d.between("dt_fim", begin, recipe.as_of)).alias("dt_fim"),
        F.when(status == "ATIVA", next_bill).alias("dt_proximo_cobr"),
        d.choice("canal_venda", SALES_CHANNELS).alias("canal_venda"),
        d.choice("cupom", COUPONS).alias("cupom"),
        (status == "TRIAL").alias("flag_trial"),
        F.when(status == "CANCELADA", d.choice("motivo_cancel", CANCEL_REASONS)).otherwise("").alias("motivo_cancel"),
    )


def uso_produto(base: DataFrame, recipe: Recipe) -> DataFrame:
    df, d, client = _start(base, "uso_produto", recipe)
    day = d.days_back("dt_evento", recipe.as_of, YEAR)
    return df.select(
        F.col("id").alias("id_uso"),
        client.alias("id_cliente"),
        d.choice_int("id_produto", ACTIVE_PRODUCTS).alias("id_produto"),
        d.choice("tipo_evento", USAGE_KINDS).alias("tipo_evento"),
        d.choice("dispositivo", DEVICES).alias("dispositivo"),
        d.randint("duracao_seg", 1, 3600).alias("duracao_seg"),
        day.alias("dt_evento"),
        period(day).alias("ano_mes"),
        d.flag("sucesso", 0.95).alias("sucesso"),
        F.when(d.flag("codigo_erro?", 0.95), "").otherwise(d.choice("codigo_erro", ERROR_CODES)).alias("codigo_erro"),
    )


def precos_historico(products: DataFrame, recipe: Recipe, months: int = MONTHS_OF_PRICES) -> DataFrame:
    """Each product (id_produto, codigo, preco_mensal) times the months: -5 % to +10 %, yearly price 10 x.

    The months are a fixed short list expanded within each product's row. Prices are whole cents.
    """
    if not 0 < months <= MONTH_KEYS:
        raise ValueError(f"a history has 1 to {MONTH_KEYS} months")
    d = Draws("precos_historico")
    rows = products.select(
        "id_produto",
        "codigo",
        F.round(F.col("preco_mensal") * 100).cast("bigint").alias("cents"),
        F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("m"),
    )
    df = with_state(rows.withColumn("id", F.col("id_produto") * MONTH_KEYS + F.col("m")), "id", recipe.seed)
    drawn = F.floor((F.col("cents") * (d.randint("variacao", -500, 1000) + 10_000) + 5_000) / 10_000)
    priced = df.withColumn("price", F.greatest(drawn, F.lit(0)).cast("bigint"))
    return priced.select(
        "id_produto",
        F.col("codigo").alias("codigo_produto"),
        period(F.add_months(F.lit(recipe.as_of), -F.col("m"))).alias("ano_mes"),
        (F.col("price") / F.lit(100.0)).alias("preco_mensal"),
        (F.col("price") * 10 / F.lit(100.0)).alias("preco_anual"),
        F.lit("BRL").alias("moeda"),
        d.choice("motivo_alteracao", PRICE_REASONS).alias("motivo_alteracao"),
    )


@dataclass
class Sizes:
    """Row counts of the default workload."""

    persons: int = 10_000
    companies: int = 2_000
    inquiries: int = 50_000
    transactions: int = 100_000
    contracts: int = 15_000
    defaults: int = 8_000

    @property
    def protests(self) -> int:
        return self.defaults // 5

    @property
    def subscriptions(self) -> int:
        return self.persons * 3 // 2

    @property
    def usages(self) -> int:
        return self.persons * 3


@dataclass
class Layout:
    database: str
    fmt: str = "parquet"
    partition_by: tuple[str, ...] = ()
    external: bool = False


# Where each table goes: database, format, partition columns, external or managed.
LAYOUTS = {
    "clientes_pf": Layout("clientes"),
    "clientes_pj": Layout("clientes"),
    "enderecos": Layout("clientes"),
    "contatos": Layout("clientes", "parquet", ("tipo_contato",), True),
    "score_historico": Layout("credito", "parquet", ("ano_mes",)),
    "consultas_credito": Layout("credito", "parquet", ("ano_mes",)),
    "limites_credito": Layout("credito"),
    "transacoes": Layout("financeiro", "parquet", ("ano_mes",)),
    "contratos": Layout("financeiro", "orc", ("status",), True),
    "ocorrencias": Layout("inadimplencia", "parquet", ("ano_mes",)),
    "protestos": Layout("inadimplencia"),
    "catalogo_produtos": Layout("produtos"),
    "assinaturas": Layout("produtos"),
    "uso_produto": Layout("produtos", "parquet", ("ano_mes",)),
    "precos_historico": Layout("produtos", "csv", (), True),
}


def generate(spark: SparkSession, recipe: Recipe, sizes: Sizes | None = None) -> dict[str, DataFrame]:
    """All fifteen tables for the given sizes, lazily."""
    sizes = sizes or Sizes()
    recipe = Recipe(recipe.as_of, sizes.persons, recipe.seed)
    persons, companies = keys(spark, sizes.persons), keys(spark, sizes.companies)
    return {
        "clientes_pf": clientes_pf(persons, recipe),
        "clientes_pj": clientes_pj(companies, recipe),
        "enderecos": enderecos(persons, companies, recipe),
        "contatos": contatos(persons, recipe),
        "score_historico": score_historico(persons, recipe),
        "consultas_credito": consultas_credito(keys(spark, sizes.inquiries), recipe),
        "limites_credito": limites_credito(persons, recipe),
        "transacoes": transacoes(keys(spark, sizes.transactions), recipe),
        "contratos": contratos(keys(spark, sizes.contracts), recipe),
        "ocorrencias": ocorrencias(keys(spark, sizes.defaults), recipe),
        "protestos": protestos(keys(spark, sizes.protests), recipe),
        "catalogo_produtos": catalogo_produtos(spark),
        "assinaturas": assinaturas(keys(spark, sizes.subscriptions), recipe),
        "uso_produto": uso_produto(keys(spark, sizes.usages), recipe),
        "precos_historico": precos_historico(catalogo_produtos(spark), recipe),
    }


def save(spark: SparkSession, name: str, df: DataFrame, base_path: str) -> str:
    """Store a generated table in its layout and return its path."""
    layout = LAYOUTS[name]
    path = f"{base_path.rstrip('/')}/{layout.database}/{name}"
    tables.write(tables.spread(df, layout.partition_by), path, layout.fmt, layout.partition_by)
    return path
