"""The analytic views over the bureau tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_parties(persons: DataFrame, companies: DataFrame) -> DataFrame:
    """Active persons and companies in one layout with a type tag: two pruned scans, no shuffle."""
    person = persons.filter(F.col("status") == "ATIVO").select(
        F.lit("PF").alias("tipo_cliente"),
        "id_cliente",
        F.col("cpf").alias("documento"),
        F.col("nome").alias("razao_nome"),
        "score_bureau",
        "faixa_score",
        F.col("uf_nascimento").alias("uf"),
        F.col("renda_mensal").alias("capacidade_financeira"),
        "dt_cadastro",
    )
    company = companies.filter(F.col("status") == "ATIVO").select(
        F.lit("PJ").alias("tipo_cliente"),
        F.col("id_empresa").alias("id_cliente"),
        F.col("cnpj").alias("documento"),
        F.col("razao_social").alias("razao_nome"),
        "score_bureau",
        "faixa_score",
        F.col("uf_sede").alias("uf"),
        F.col("faturamento_anual").alias("capacidade_financeira"),
        "dt_cadastro",
    )
    return person.unionByName(company)


def latest(df: DataFrame, key: str, moment: str) -> DataFrame:
    """All rows of each key's latest moment; ties stay.

    The latest moment is aggregated on the map side and joined back on (key, moment). The join hashes
    both columns, so a key with very many rows spreads over its moments, and the adaptive planner can
    split what is still skewed; a window would sort such a key in one task.
    """
    newest = df.groupBy(key).agg(F.max(moment).alias(moment))
    return df.join(newest, [key, moment])


def current_score(scores: DataFrame, limits: DataFrame) -> DataFrame:
    """Each client's latest score, with the credit limit where it is active."""
    score_columns = [
        "id_cliente", "score", "faixa_score", "num_consultas_mes", "num_dividas_ativas",
        "valor_dividas", "flag_negativado", "dt_calculo",
    ]
    limit_columns = ["limite_aprovado", "limite_disponivel", "taxa_juros_mensal"]
    active = limits.filter(F.col("status") == "ATIVO").select("id_cliente", *limit_columns)
    current = latest(scores.select(*score_columns, "ano_mes"), "id_cliente", "ano_mes")
    return current.join(active, "id_cliente", "left").select(*score_columns, *limit_columns)


def money_sum(column: str):
    """A sum of two-decimal amounts that does not depend on the order of rows."""
    return F.sum(F.col(column).cast("decimal(18,2)"))


def open_defaults(defaults: DataFrame, protests: DataFrame) -> DataFrame:
    """Per client: open defaults, and active protests (0 where there are none).

    Both sides are reduced to one row per client before they meet.
    """
    per_client = (
        defaults.filter(F.col("status") == "ATIVA")
        .groupBy("id_cliente")
        .agg(
            F.count("id_ocorrencia").alias("qtd_ocorrencias"),
            money_sum("valor_atualizado").alias("total_divida"),
            F.max("dias_atraso").alias("max_dias_atraso"),
            F.min("dt_ocorrencia").alias("primeira_ocorrencia"),
            F.max("dt_ocorrencia").alias("ultima_ocorrencia"),
            F.count_distinct("credor").alias("qtd_credores"),
        )
    )
    protested = (
        protests.filter(F.col("status") == "ATIVO")
        .groupBy("id_cliente")
        .agg(F.count("*").alias("qtd_protestos"), money_sum("valor_protestado").alias("total_protestado"))
    )
    return per_client.join(protested, "id_cliente", "left").withColumns(
        {
            "qtd_protestos": F.coalesce("qtd_protestos", F.lit(0)),
            "total_protestado": F.coalesce("total_protestado", F.lit(0)),
        }
    )


def score_band(score):
    return F.when(score >= 800, "A").when(score >= 500, "B").otherwise("C")


def clients_by_band(clients: DataFrame, bands: DataFrame, state: str = "SP") -> DataFrame:
    """Clients of one state with the description of their score band (codigo, descricao).

    The join key is computed from the score. At most three rows are broadcast, one a letter; of several descriptions of
    a letter the smallest counts.
    """
    banded = clients.filter(F.col("uf") == state).withColumn("codigo", score_band(F.col("score")))
    letters = bands.filter(F.col("codigo").isin("A", "B", "C")).groupBy("codigo").agg(F.min("descricao").alias("faixa"))
    return banded.join(F.broadcast(letters), "codigo").select("id", "nome", "score", "faixa")
