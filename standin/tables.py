"""Source tables derived from the given tables.

Each text is plain SQL that Spark and DuckDB both read, so both sides of a check start from the
same rows: ``{name}`` stands for another table and ``{ts}`` for the timestamp type without zone.
The columns hold the irregular values (blanks, null words, punctuation, bad numbers, shared ids)
the cleaning rules are about. Every table grows with the given tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.catalog import FrameSource

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

TEXTS: dict[str, str] = {}

TEXTS["contract_lines"] = """
SELECT l.l_orderkey AS contract_id,
       CASE o.o_orderstatus WHEN 'F' THEN 6 WHEN 'O' THEN 7 ELSE
         CASE o.o_orderkey % 4 WHEN 0 THEN 8 WHEN 1 THEN 11 WHEN 2 THEN 0 ELSE NULL END
       END AS status,
       o.o_custkey AS customer_id,
       CASE o.o_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '   '
         WHEN 2 THEN '  Group ' || CAST(o.o_custkey % 50 AS STRING) || ' '
         ELSE 'Group ' || CAST(o.o_custkey % 50 AS STRING) END AS customer_name,
       CASE WHEN o.o_orderkey % 17 = 3 THEN
         CASE l.l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'A|' END ELSE
         CASE o.o_custkey % 3 WHEN 0 THEN 'Group ' || CAST(o.o_custkey % 50 AS STRING)
         WHEN 1 THEN 'System ' || c.c_mktsegment ELSE NULL END END AS system_name,
       CASE WHEN l.l_partkey % 5 = 0 THEN NULL ELSE l.l_partkey END AS store_client_id,
       CASE l.l_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '|' || p.p_name ELSE p.p_name END
         AS store_client_name,
       CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE CAST(o.o_orderkey % 28 + 1 AS INT) END
         AS billing_day,
       CASE WHEN o.o_orderkey % 8 = 0 THEN NULL ELSE CAST(o.o_orderkey % 27 + 2 AS INT) END
         AS due_day,
       l.l_orderkey * 10 + l.l_linenumber AS line_id,
       l.l_suppkey AS store_id,
       CAST(replace(p.p_brand, 'Brand#', '') AS BIGINT) AS brand_id,
       CAST(s.s_nationkey AS BIGINT) AS chain_id,
       l.l_suppkey % 8 AS task_id,
       CASE l.l_suppkey % 8 WHEN 0 THEN 'Estoque' WHEN 1 THEN ' desruptura '
         WHEN 2 THEN 'Pesquisa   de Preço' WHEN 3 THEN 'pesquisa de preço'
         WHEN 4 THEN 'Manutenção de Ponto Extra' WHEN 5 THEN p.p_type || ' ' || o.o_orderpriority
         WHEN 6 THEN 'Validade' ELSE 'reabastecimento & ruptura' END AS task_name,
       CASE WHEN o.o_custkey % 13 = 0 THEN ' ' ELSE
         ' ' || substr(c.c_mktsegment, 1, 4) || ' ' || substr(c.c_mktsegment, 5) END
         AS segment_names,
       CASE WHEN o.o_orderkey % 23 = 4 THEN
         CASE l.l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '1|' END ELSE
         CASE l.l_linenumber WHEN 1 THEN '0.25' WHEN 2 THEN '0.5' WHEN 3 THEN '1' WHEN 4 THEN '1.5'
         WHEN 5 THEN '2.5' WHEN 6 THEN '3' ELSE
         CASE l.l_suppkey % 5 WHEN 0 THEN '15' WHEN 1 THEN '30' WHEN 2 THEN '3.4' WHEN 3 THEN 'x'
           ELSE '99' END END END AS frequency,
       CASE WHEN l.l_partkey % 53 = 0 THEN NULL WHEN l.l_partkey % 59 = 0 THEN 'n/d' ELSE
         CAST(CAST(l.l_quantity AS INT) AS STRING) ||
         CASE l.l_partkey % 5 WHEN 0 THEN ',5' WHEN 1 THEN '.5' ELSE '' END END AS hours,
       CASE WHEN l.l_partkey % 41 = 0 THEN NULL ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END
         AS price,
       CASE WHEN o.o_orderkey % 37 = 0 THEN NULL ELSE o.o_orderdate END AS start_at,
       CASE WHEN l.l_linestatus = 'O' THEN NULL ELSE l.l_shipdate END AS notice_at,
       o.o_orderdate - INTERVAL '10' DAY AS contract_created_at,
       CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE o.o_orderdate + INTERVAL '5' DAY END
         AS contract_updated_at,
       CASE WHEN l.l_partkey % 31 = 0 THEN NULL ELSE l.l_shipdate - INTERVAL '30' DAY END
         AS line_created_at,
       CASE WHEN l.l_linenumber % 2 = 0 THEN NULL ELSE l.l_shipdate END AS line_updated_at
FROM {lineitem} l
JOIN {orders} o ON o.o_orderkey = l.l_orderkey
JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {supplier} s ON s.s_suppkey = l.l_suppkey
JOIN {part} p ON p.p_partkey = l.l_partkey
"""

TEXTS["contract_master"] = """
SELECT o_orderkey AS contract_id,
       CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey % 160 END AS seller_id,
       'mode ' || o_orderstatus AS billing_mode,
       o_orderpriority AS operation,
       CAST(o_orderkey % 3 AS INT) AS thirteenth_rule,
       CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE 'N' END AS trade_marketing,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END
         AS equipment_amount,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2))
         ELSE CAST(0 AS DECIMAL(18,2)) END AS trade_amount,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey AS DECIMAL(18,2)) END AS other_amount,
       CASE WHEN o_orderkey % 7 = 0 THEN CAST(-1 AS DECIMAL(18,2))
         WHEN o_orderkey % 7 = 1 THEN CAST(12.5 AS DECIMAL(18,2)) END AS interest_amount,
       CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_custkey + 1 AS DECIMAL(18,2)) END
         AS discount_amount,
       CASE WHEN o_orderkey % 13 = 0 THEN CAST(99.99 AS DECIMAL(18,2)) END AS fine_amount,
       CASE o_orderkey % 6 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE FALSE END AS equipment_charged,
       CASE WHEN o_orderkey % 8 = 0 THEN o_orderdate + INTERVAL '3' DAY END AS equipment_start_at,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderdate END AS created_at,
       CASE WHEN o_orderkey % 4 = 1 THEN o_orderdate + INTERVAL '9' DAY END AS updated_at
FROM {orders}
"""

TEXTS["line_flags"] = """
SELECT l_orderkey * 10 + l_linenumber AS line_id,
       CASE min(l_suppkey) % 3 WHEN 0 THEN NULL WHEN 1 THEN FALSE ELSE TRUE END AS active
FROM {lineitem} GROUP BY l_orderkey * 10 + l_linenumber HAVING min(l_partkey) % 5 <> 0
"""

TEXTS["parties"] = """
SELECT k AS id,
       CASE WHEN k % 9 = 0 THEN NULL ELSE k + 1000 END AS code,
       ' Sys ' || t AS system_name,
       CASE k % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'J' ELSE NULL END AS person_type,
       CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN '00.000.000/0000-00'
         WHEN 2 THEN substr(pad, 4, 3) || '.' || substr(pad, 7, 3) || '.' || substr(pad, 10, 3)
           || '-' || substr(pad, 13, 2)
         WHEN 3 THEN '12.345.678/0001-95'
         ELSE substr(grp, 1, 2) || '.' || substr(grp, 3, 3) || '.' || substr(grp, 6, 3) || '/'
           || substr(grp, 9, 4) || '-' || substr(grp, 13, 2) END AS tax_id,
       CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN '12.345.' || t
         WHEN 3 THEN '99999999999' WHEN 4 THEN '3000000000' ELSE ' ' || t END
         AS state_registration,
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '000-0' WHEN 2 THEN 'IM ' || t ELSE t END
         AS municipal_registration,
       CASE WHEN k % 17 = 0 THEN ' None ' ELSE ' ' || nm || chr(9) END AS legal_name,
       CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'Trade ' || t ELSE NULL END AS trade_name,
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN FALSE ELSE TRUE END AS active,
       CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN 'null' ELSE 'Rua ' || t END
         AS main_street,
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE t || 'A' END AS main_number,
       CASE k % 3 WHEN 0 THEN ' Bloco ' || t ELSE NULL END AS main_address_line_2,
       CASE k % 6 WHEN 0 THEN NULL ELSE ' Bairro ' || CAST(k % 30 AS STRING) || ' ' END
         AS main_neighborhood,
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '00000-000' ELSE '01.' || pad END
         AS main_postal_code,
       CASE k % 4 WHEN 0 THEN lower(city) WHEN 1 THEN replace(city, 'A', 'Á')
         WHEN 2 THEN ' ' || city || ' ! ' ELSE 'elsewhere' END AS main_city,
       CASE k % 7 WHEN 0 THEN '35-' || t WHEN 1 THEN '0' ELSE NULL END AS main_place_code,
       CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN lower(state) ELSE state END AS main_state,
       CASE k % 4 WHEN 0 THEN '-23,5' || t WHEN 1 THEN '12.25' WHEN 2 THEN 'x' ELSE NULL END
         AS main_latitude,
       CASE k % 3 WHEN 0 THEN ' -46,125 ' WHEN 1 THEN '1,2,3' ELSE NULL END AS main_longitude,
       CASE k % 3 WHEN 0 THEN 'Av. ' || t ELSE NULL END AS billing_street,
       t AS billing_number,
       CAST(NULL AS STRING) AS billing_address_line_2,
       'Centro' AS billing_neighborhood,
       substr(pad, 7, 8) AS billing_postal_code,
       city AS billing_city,
       CASE k % 5 WHEN 0 THEN 'n' || t ELSE NULL END AS billing_place_code,
       replace(state, 'I', 'Í') AS billing_state,
       CASE k % 5 WHEN 0 THEN ' User' || t || '@Mail.Example ' WHEN 1 THEN 'PENDENTE'
         WHEN 2 THEN 'bad@' WHEN 3 THEN NULL ELSE 'c' || t || '@x.example.com' END AS email,
       CASE k % 4 WHEN 0 THEN 'R' || t || '@mail.example' WHEN 1 THEN 'n/a' ELSE NULL END
         AS responsible_email,
       CASE k % 3 WHEN 0 THEN 'A' || t || '@x.com, b@y , PENDENTE,c' || t || '@z.org,'
         WHEN 1 THEN ' ' ELSE NULL END AS billing_emails,
       CASE k % 6 WHEN 0 THEN 'sales+' || t || '@shop.example' ELSE '' END AS commercial_email,
       CASE k % 7 WHEN 0 THEN '(11) 9' || substr(pad, 7, 8) WHEN 1 THEN '11 ' || substr(pad, 7, 8)
         WHEN 2 THEN '12345678' WHEN 3 THEN '000.0000.0000' WHEN 4 THEN '' WHEN 5 THEN NULL
         ELSE '55 11 9' || substr(pad, 7, 8) END AS phone,
       CASE k % 4 WHEN 0 THEN '21-9' || substr(pad, 7, 8) WHEN 1 THEN 'none' ELSE NULL END
         AS cellphone,
       CASE k % 5 WHEN 0 THEN '31 ' || substr(pad, 7, 8) ELSE NULL END AS responsible_phone,
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE ' Ana ' || t END AS contact_person,
       'Finance ' || t AS contact_job,
       CASE k % 3 WHEN 0 THEN 'Buyer ' || t ELSE NULL END AS buyer,
       ' ' AS buyer_job,
       CASE k % 5 WHEN 0 THEN ' note ' || t ELSE NULL END AS notes,
       CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN ' pendente ' WHEN 2 THEN '' ELSE 'Holder ' || t END
         AS shareholder_name,
       CASE k % 2 WHEN 0 THEN 'Partner' ELSE NULL END AS shareholder_job,
       CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Pendente' ELSE 'Praça ' || t END
         AS shareholder_street,
       t AS shareholder_number,
       CAST(NULL AS STRING) AS shareholder_address_line_2,
       'Sul' AS shareholder_neighborhood,
       '0-0' AS shareholder_postal_code,
       city AS shareholder_city,
       CAST(NULL AS STRING) AS shareholder_place_code,
       state AS shareholder_state,
       CASE k % 4 WHEN 0 THEN '41 ' || substr(pad, 7, 8) WHEN 1 THEN '123' ELSE NULL END
         AS shareholder_phone,
       CASE k % 5 WHEN 0 THEN substr(pad, 4, 11) WHEN 1 THEN '1' || substr(pad, 6, 9)
         WHEN 2 THEN '000.000.000-00' WHEN 3 THEN t ELSE '2' || substr(pad, 5, 10) END
         AS shareholder_national_id,
       'RG ' || t AS shareholder_identity_card,
       CASE k % 2 WHEN 0 THEN 'BR' ELSE ' ' END AS shareholder_nationality,
       CAST(k % 6 AS INT) AS shareholder_marital_status,
       CAST('2019-' || month || '-01 09:00:00' AS {ts}) AS created_at,
       CASE k % 3 WHEN 0 THEN NULL ELSE CAST('2020-' || month || '-15 10:30:00' AS {ts}) END
         AS updated_at,
       CASE k % 4 WHEN 0 THEN NULL ELSE CAST('2019-' || month || '-02 00:00:00' AS {ts}) END
         AS activated_at,
       CASE k % 8 WHEN 0 THEN CAST('2021-' || month || '-03 00:00:00' AS {ts}) END
         AS deactivated_at
FROM (
  SELECT c.c_custkey AS k, CAST(c.c_custkey AS STRING) AS t, c.c_name AS nm,
         lpad(CAST(c.c_custkey AS STRING), 14, '0') AS pad,
         lpad(CAST(c.c_custkey % 400 + 1 AS STRING), 14, '0') AS grp,
         lpad(CAST(c.c_custkey % 12 + 1 AS STRING), 2, '0') AS month,
         n.n_name AS city, r.r_name AS state
  FROM {customer} c
  JOIN {nation} n ON n.n_nationkey = c.c_nationkey
  JOIN {region} r ON r.r_regionkey = n.n_regionkey
) x
"""

TEXTS["store_records"] = """
SELECT k AS id,
       CASE WHEN k % 4 = 0 THEN NULL ELSE 'S-' || t END AS code,
       CASE WHEN k % 23 = 0 THEN 'NONE' ELSE ' ' || nm || ' ' END AS name,
       CASE WHEN k % 10 = 0 THEN NULL ELSE k % 27 + 1 END AS brand_id,
       CASE WHEN k % 7 = 0 THEN NULL ELSE k % 6 END AS channel_id,
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '0000' ELSE t || '/0001-00' END AS tax_id,
       CASE k % 5 WHEN 0 THEN '  ' ELSE 'Rodovia ' || t END AS main_street,
       CASE k % 3 WHEN 0 THEN 'none' ELSE t END AS main_number,
       CAST(NULL AS STRING) AS main_address_line_2,
       CASE k % 2 WHEN 0 THEN NULL ELSE 'Distrito ' || t END AS main_neighborhood,
       '0' || t || '-000' AS main_postal_code,
       CASE k % 3 WHEN 0 THEN replace(city, 'N', 'Ñ') WHEN 1 THEN lower(city) ELSE NULL END
         AS main_city,
       state AS main_state,
       '-' || t || ',75' AS main_latitude,
       CAST(NULL AS STRING) AS main_longitude,
       CASE k % 3 WHEN 0 THEN ' Store' || t || '@Shop.Example' ELSE ' ' END AS email,
       CASE k % 2 WHEN 0 THEN '(0' || t || ') 1-2' ELSE 'n/a' END AS phone,
       CASE k % 5 WHEN 0 THEN t || '-9' ELSE NULL END AS cellphone,
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN FALSE ELSE TRUE END AS active,
       CAST('2018-' || month || '-01 07:00:00' AS {ts}) AS created_at,
       CASE k % 3 WHEN 0 THEN NULL ELSE CAST('2018-' || month || '-20 07:00:00' AS {ts}) END
         AS updated_at
FROM (
  SELECT s.s_suppkey AS k, CAST(s.s_suppkey AS STRING) AS t, s.s_name AS nm,
         lpad(CAST(s.s_suppkey % 12 + 1 AS STRING), 2, '0') AS month,
         n.n_name AS city, r.r_name AS state
  FROM {supplier} s
  JOIN {nation} n ON n.n_nationkey = s.s_nationkey
  JOIN {region} r ON r.r_regionkey = n.n_regionkey
) x
"""

_DATED = """CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN FALSE ELSE TRUE END AS active,
       CAST('2017-03-01 00:00:00' AS {ts}) AS created_at,
       CASE id % 3 WHEN 0 THEN NULL ELSE CAST('2017-04-01 12:00:00' AS {ts}) END AS updated_at"""

TEXTS["brands"] = f"""
SELECT id, CASE WHEN id % 13 = 0 THEN ' null ' ELSE ' ' || label END AS name,
       CASE WHEN id % 5 = 0 THEN NULL ELSE 'B' || CAST(id AS STRING) END AS code,
       CASE WHEN id % 6 = 0 THEN NULL WHEN id % 7 = 0 THEN 999 ELSE id % 25 END AS chain_id,
       {_DATED}
FROM (SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS id, p_brand AS label
      FROM {{part}}) x
"""

TEXTS["chains"] = f"""
SELECT id, CASE WHEN id % 11 = 10 THEN '' ELSE 'Chain ' || label END AS name,
       CASE WHEN id % 2 = 0 THEN NULL ELSE 'R' || CAST(id AS STRING) END AS code, {_DATED}
FROM (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS label FROM {{nation}}) x
"""

TEXTS["segments"] = f"""
SELECT id, label AS name, {_DATED}
FROM (SELECT DISTINCT CAST(ascii(c_mktsegment) AS BIGINT) AS id, c_mktsegment AS label
      FROM {{customer}}) x
"""

TEXTS["channels"] = f"""
SELECT id, CASE WHEN id = 3 THEN 'None' ELSE ' ' || label || ' ' END AS name, {_DATED}
FROM (SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS label FROM {{region}}) x
"""

TEXTS["places"] = """
SELECT '35' || lpad(CAST(n.n_nationkey AS STRING), 5, '0') AS code, n.n_name AS city,
       r.r_name AS state
FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey
UNION ALL
SELECT CASE n_nationkey % 3 WHEN 0 THEN '0' WHEN 1 THEN NULL ELSE '99' END AS code,
       lower(n_name) AS city, CASE n_nationkey % 2 WHEN 0 THEN 'áfrica' ELSE '' END AS state
FROM {nation}
"""

TEXTS["source_users"] = """
SELECT k AS id,
       CASE WHEN k % 19 = 0 THEN 'None' ELSE 'User ' || t || ' ' END AS name,
       CASE k % 5 WHEN 0 THEN NULL ELSE ' User.' || t END AS login,
       CASE k % 4 WHEN 0 THEN 'U' || t || '@Corp.Example' ELSE NULL END AS email,
       CASE k % 3 WHEN 0 THEN '' ELSE '555-' || t END AS phone,
       CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN '000' ELSE '1' || lpad(t, 9, '0') END
         AS national_id,
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN FALSE ELSE TRUE END AS active,
       first_seen AS created_at,
       CASE k % 2 WHEN 0 THEN NULL ELSE last_seen END AS updated_at
FROM (SELECT user_id AS k, CAST(user_id AS STRING) AS t, min(ts) AS first_seen,
             max(ts) AS last_seen FROM {events} GROUP BY user_id) x
"""

TEXTS["sheet"] = """
SELECT doc_id * 2 AS sheet_row, CAST(doc_id AS STRING) AS id_orcamento,
       CASE quality WHEN 1 THEN ' Sim ' ELSE 'nao' END AS migrar,
       CASE WHEN toxic = 1 THEN 'não' WHEN doc_id % 3 = 0 THEN NULL ELSE 'TRUE' END
         AS orcamento_ativo,
       CASE doc_id % 4 WHEN 0 THEN NULL ELSE 'Sheet ' || CAST(doc_id AS STRING) END
         AS nome_cliente,
       CASE doc_id % 5 WHEN 0 THEN 'x' WHEN 1 THEN NULL ELSE CAST(doc_id % 28 + 1 AS STRING) END
         AS dia_faturamento,
       CASE doc_id % 6 WHEN 0 THEN NULL ELSE CAST(doc_id % 25 + 3 AS STRING) END
         AS dia_vencimento,
       CASE doc_id % 3 WHEN 0 THEN '5 Weeks' WHEN 1 THEN '4 weeks' ELSE NULL END
         AS tipo_fat_descricao,
       CASE doc_id % 4 WHEN 0 THEN 'Post - Paid!' WHEN 1 THEN ' NULL ' WHEN 2 THEN 'Advance'
         ELSE NULL END AS contract_parameters_billing_type,
       CASE doc_id % 3 WHEN 0 THEN '__In  two parts' ELSE '' END
         AS contract_parameters_thirteenth_salary_type,
       CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '#tbd'
         WHEN 2 THEN 'USER.' || CAST(doc_id % 150 AS STRING)
         WHEN 3 THEN 'u' || CAST(doc_id % 150 AS STRING) || '@corp.example'
         ELSE '1' || lpad(CAST(doc_id % 150 AS STRING), 9, '0') END AS farmer_login_user,
       CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE 'user.' ||
         CAST(doc_id % 170 AS STRING) END AS hunter_login_user
FROM {labels}
UNION ALL
SELECT doc_id * 2 + 1, CASE quality WHEN 1 THEN CAST(doc_id AS STRING) ELSE 'total' END, 'sim',
       NULL, 'Second', '9', '9', '5 weeks', 'second', 'second', 'user.1', 'user.2'
FROM {labels}
"""

TEXTS["people"] = "SELECT 'P' || lpad(CAST(s_suppkey AS STRING), 9, '0') AS id FROM {supplier}"

TEXTS["roles"] = "SELECT 'role-' || lower(r_name) AS id FROM {region}"

_NAME = re.compile(r"\{([a-z]\w*)\}")


def _names(text: str) -> list[str]:
    return [n for n in dict.fromkeys(_NAME.findall(text)) if n != "ts"]


class Tables:
    """The given tables of one folder and, built on demand, the derived ones."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in GIVEN:
                self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                self._frames[name] = self.sql(TEXTS[name])
        return self._frames[name]

    def shared(self, name: str, build: Callable[[Tables], DataFrame]) -> DataFrame:
        """A derived frame that several parts of one query use, planned once."""
        if name not in self._frames:
            self._frames[name] = build(self)
        return self._frames[name]

    def sql(self, text: str) -> DataFrame:
        frames = {n: self[n] for n in _names(text)}
        return self.spark.sql(text.replace("{ts}", "TIMESTAMP_NTZ"), **frames)

    @cached_property
    def source(self) -> FrameSource:
        return FrameSource({n: self[n] for n in TEXTS})


def duckdb_sql(text: str) -> str:
    """A DuckDB query with the derived tables it uses as common table expressions."""
    needed: list[str] = []

    def visit(t: str) -> None:
        for n in _names(t):
            if n not in GIVEN and n not in needed:
                visit(TEXTS[n])
                needed.append(n)

    visit(text)

    def plain(t: str) -> str:
        return _NAME.sub(lambda m: "TIMESTAMP" if m[1] == "ts" else m[1], t).strip()

    ctes = [f"{n} AS (\n{plain(TEXTS[n])}\n)" for n in needed]
    body = plain(text)
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(ctes)},{body[4:]}"
    return f"WITH {', '.join(ctes)}\n{body}"
