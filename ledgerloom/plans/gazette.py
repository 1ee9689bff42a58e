"""Gazette-like blocks made from the order tables, as one SQL text that Spark and DuckDB both run.

The tables hold no gazette text, so operators on blocks would have nothing to find. Each customer
is a document and each of its orders adds up to eight blocks: section and organisation headings,
titles, bodies with process numbers, identifiers (some with a wrong check digit), amounts and norms,
actions with persons, page numbers and running lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions import vocabulary as V


def _check(digits: str, length: int) -> str:
    """SQL of a check digit of a string of digits; for oracles."""
    weights = [*range(length - 7, 1, -1), *range(9, 1, -1)]
    total = " + ".join(f"cast(substr({digits}, {i + 1}, 1) as int) * {w}" for i, w in enumerate(weights))
    return f"case when ({total}) % 11 < 2 then 0 else 11 - ({total}) % 11 end"


def _made(digits: tuple[int, ...], fixed: str) -> str:
    """The same where only the 5th to 8th digits of 0000xxxx0001 vary: x is the number that they make."""
    places = [f"cast(floor(x / {10 ** (3 - i)}) as bigint) % 10 * {w}" for i, w in enumerate(digits)]
    total = f"mod({' + '.join(places)} + {fixed}, 11)"
    return f"case when {total} < 2 then 0 else 11 - {total} end"


TITLES = "case ok % 6 when 0 then 'PORTARIA Nº ' when 1 then 'Decreto nº ' when 2 then 'EDITAL Nº ' when 3 then 'ORDEM DE SERVIÇO Nº ' when 4 then 'EXTRATO DO CONTRATO Nº ' else 'RESOLUÇÃO Nº ' end"
MONTH = "case ok % 3 when 0 then 'JUNHO' when 1 then 'MARÇO' else 'BRUMARIO' end"
PEOPLE = "case ok % 4 when 0 then 'FULANO DE TAL' when 1 then 'BELTRANA DA CONCEIÇÃO' when 2 then 'SICRANO ÁVILA' else 'Maria Souza' end"

#: (number, when, text, role, noise)
KINDS = [
    (0, "rn = 1", "'Sumário da edição ' || cast(doc as varchar(20))", "'paragraph'", "false"),
    (1, "rn in (1, 5, 9) or (rn = 7 and ok % 2 = 0)", "case rn when 1 then 'SEÇÃO I' when 5 then 'Seção II' when 9 then 'SEÇÃO III' else 'SEÇÃO I' end", "'h1'", "false"),
    (2, "ok % 3 = 0", "'SECRETARIA DE ESTADO DE ' || case ok % 5 when 0 then 'SAÚDE' when 1 then 'EDUCAÇÃO' else 'OBRAS E' end", "'h2'", "false"),
    (3, "ok % 6 = 0", "case ok % 12 when 0 then 'DO DISTRITO' else 'CAPÍTULO NOVO' end", "'h2'", "false"),
    (4, "ok % 5 = 0", "case when ok % 10 = 0 then 'SUBSECRETARIA DE GESTÃO' else 'JOÃO DA SILVA LTDA' end", "'paragraph'", "false"),
    (5, "ok % 7 <> 0", f"{TITLES} || cast(ok % 90 + 1 as varchar(20)) || ', DE ' || cast(ok % 31 + 1 as varchar(20)) || ' DE ' || {MONTH} || ' DE 2026.'", "case when ok % 8 = 0 then 'h3' else 'paragraph' end", "false"),
    (6, "true", "'Art. 1º Fica autorizado o processo ' || process || ', da empresa ' || cnpj || ', no valor de ' || money || ', conforme a LEI Nº ' || cast(ok % 50 + 100 as varchar(20)) || '/2020. Art. 2º Publique-se.'", "'paragraph'", "false"),
    (7, "ok % 2 = 0", f"case ok % 12 when 0 then 'NOMEAR' when 2 then 'Exonerar' when 4 then 'EXONERAR, A PEDIDO' when 6 then 'TORNAR SEM EFEITO' when 8 then 'DESIGNAR' else 'CESSAR OS  EFEITOS' end || ', ' || {PEOPLE} || ', ' || case ok % 5 when 0 then 'matrícula 123' when 1 then 'Assessor Especial' when 2 then ' Chefe  de Gabinete ' when 3 then 'X' else 'Diretora' end || ', da Secretaria.'", "'paragraph'", "false"),
    (8, "ok % 9 = 0", "case when ok % 2 = 0 then cast(rn as varchar(20)) else 'PÁGINA 3 Diário Oficial do Distrito Federal' end", "'paragraph'", "true"),
    (9, "ok % 11 = 0", f"case when ok % 2 = 0 then '{V.PUBLICATION_HEADER}' else '{V.IMPRINT} Palácio' end", "'h2'", "false"),
]

def blocks_sql(orders: str, each: str) -> str:
    """each: the dialect's way to repeat a row for k = 0 .. 9."""
    pick = lambda part: "case k " + " ".join(f"when {kind[0]} then {kind[part]}" for kind in KINDS) + " end"
    return f"""
g_a as (select o_custkey as doc, o_orderkey as ok, row_number() over (partition by o_custkey order by o_orderkey) as rn from {orders}),
g_b as (select *, (doc * 7919 + rn % 5) % 10000 as x from g_a),
g_c as (select *, {_made((9, 8, 7, 6), '2')} as c1 from g_b),
g_d as (select *, ({_made((2, 9, 8, 7), '3 + c1 * 2')} + case when ok % 9 = 4 then 1 else 0 end) % 10 as c2 from g_c),
g_orders as (select doc, ok, rn,
  printf('CNPJ 00.00%d.%03d/0001-%d%d', cast(floor(x / 1000) as bigint), x % 1000, c1, c2) as cnpj,
  printf('%05d-%08d/%04d-%02d', rn % 4, doc, 2000 + doc % 26, doc % 89) as process,
  printf('R$ %d.%03d,%02d', ok % 900 + 1, ok % 1000, ok % 100) as money, {each} as k from g_d),
g_kinds as (select doc, rn, k, {pick(1)} as there, {pick(2)} as text, {pick(3)} as role, {pick(4)} as noise from g_orders),
blocks as (select doc as doc_id, cast(floor((rn + 1) / 2) as int) as page, cast(rn * 10 + k as int) as ord,
  printf('p%04d-b%04d', cast(floor((rn + 1) / 2) as int), cast(rn * 10 + k as int)) as block_id, text, role, noise from g_kinds where there)"""


#: Orders of a task; each makes three to four blocks, and those some thirty words.
TASK = 50_000


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page, ord, block_id, text, role, noise; documents dealt over tasks.

    An order is a few bytes and its blocks some hundred times that, so partitions that are right for the orders' size
    would be far too few and too large for the blocks: their number follows the orders.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey")
    tasks = max(spark.sparkContext.defaultParallelism, -(-orders.count() // TASK))
    dealt = orders.repartition(tasks, "o_custkey")
    return spark.sql("with " + blocks_sql("{orders}", "explode(sequence(0, 9))") + " select * from blocks", orders=dealt)


def oracle(query: str, *ctes: str) -> str:
    """DuckDB SQL of a query over `blocks` and further common table expressions."""
    return "with recursive " + ",\n".join([blocks_sql("orders", "unnest(range(0, 10))"), *ctes]) + "\n" + query
