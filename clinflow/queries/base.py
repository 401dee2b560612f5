"""What the queries' SQL starts from: the facts of each message, from the base tables, without parsing a message."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Config tables of the examples: small, fixed and local.
TYPES = ("ADT", "ORU", "MDM", "ORM", "IPLORU")

M = r"""m AS (SELECT o_orderkey AS msg_id, 'F' || lpad(c_nationkey::VARCHAR, 2, '0') AS fac, strftime(o_orderdate, '%Y%m%d%H%M') AS t7,
  ['ADT','ORU','MDM','ORM'][(o_orderkey % 4 + 1)::INT] AS typ, ['A04','R01','T02','O01'][(o_orderkey % 4 + 1)::INT] AS trig,
  ['MT6_','MT_','EPIC_','ECW_','NG_','IP_'][(o_orderkey % 6 + 1)::INT] AS prefix, ['2.4','2.5','2.3','2.3.1','2.3','2.5'][(o_orderkey % 6 + 1)::INT] AS ver,
  'M' || o_custkey AS mrn, lpad((o_custkey % 1000)::VARCHAR, 3, '0') || '-' || lpad((o_custkey % 100)::VARCHAR, 2, '0') || '-' || lpad((o_custkey % 10000)::VARCHAR, 4, '0') AS ssn,
  'U' || o_custkey AS urn, split_part(c_name, '#', 1) AS n1, split_part(c_name, '#', 2) AS n2, 'A' || o_orderkey AS acct,
  CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'E' ELSE '' END AS cls, o_orderpriority AS prio,
  CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE ['MT6_','MT_','EPIC_','ECW_','NG_','IP_'][(o_orderkey % 6 + 1)::INT] || 'F' || lpad(c_nationkey::VARCHAR, 2, '0') || '_' || ['ADT','ORU','MDM','ORM'][(o_orderkey % 4 + 1)::INT] || '_' || o_orderkey END AS ctrl
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

X = """x AS (SELECT l_orderkey AS msg_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS n,
  l_partkey::VARCHAR AS part, l_returnflag AS flag, l_quantity::DECIMAL(12,2)::VARCHAR AS qty, l_linestatus AS st, strftime(l_shipdate, '%Y%m%d') AS ship FROM lineitem)"""

#: Every element that is not empty.
E = r"""e AS (SELECT * FROM (
  SELECT msg_id, 1 AS seg_seq, 'MSH' AS seg, unnest([{'field':1,'rep':1,'comp':1,'value':CASE WHEN msg_id % 5 = 0 THEN '$' ELSE '|' END},{'field':2,'rep':1,'comp':1,'value':CASE WHEN msg_id % 5 = 0 THEN '*!\@' ELSE '^~\&' END},{'field':3,'rep':1,'comp':1,'value':'CLIN'},{'field':4,'rep':1,'comp':1,'value':fac},
   {'field':5,'rep':1,'comp':1,'value':'RCV'},{'field':6,'rep':1,'comp':1,'value':'HUB'},{'field':7,'rep':1,'comp':1,'value':t7},{'field':9,'rep':1,'comp':1,'value':typ},{'field':9,'rep':1,'comp':2,'value':trig},
   {'field':10,'rep':1,'comp':1,'value':ctrl},{'field':11,'rep':1,'comp':1,'value':'P'},{'field':12,'rep':1,'comp':1,'value':ver}], recursive := true) FROM m
  UNION ALL SELECT msg_id, 2, 'PID', unnest([{'field':1,'rep':1,'comp':1,'value':'1'},{'field':3,'rep':1,'comp':1,'value':mrn},{'field':3,'rep':1,'comp':4,'value':fac},{'field':3,'rep':1,'comp':5,'value':'MRN'},
   {'field':3,'rep':2,'comp':1,'value':ssn},{'field':3,'rep':2,'comp':5,'value':'SS'},{'field':4,'rep':1,'comp':1,'value':urn},{'field':5,'rep':1,'comp':1,'value':n1},{'field':5,'rep':1,'comp':2,'value':n2},{'field':18,'rep':1,'comp':1,'value':acct}], recursive := true) FROM m
  UNION ALL SELECT msg_id, 3, 'PV1', unnest([{'field':1,'rep':1,'comp':1,'value':'1'},{'field':2,'rep':1,'comp':1,'value':cls}], recursive := true) FROM m
  UNION ALL SELECT msg_id, 4, 'OBR', unnest([{'field':1,'rep':1,'comp':1,'value':'1'},{'field':4,'rep':1,'comp':1,'value':prio},{'field':4,'rep':1,'comp':2,'value':'text'}], recursive := true) FROM m
  UNION ALL SELECT msg_id, (4 + n)::INT, 'OBX', unnest([{'field':1,'rep':1,'comp':1,'value':n::VARCHAR},{'field':2,'rep':1,'comp':1,'value':'NM'},{'field':3,'rep':1,'comp':1,'value':part},{'field':3,'rep':1,'comp':2,'value':flag},
   {'field':5,'rep':1,'comp':1,'value':qty},{'field':6,'rep':1,'comp':1,'value':st},{'field':14,'rep':1,'comp':1,'value':ship}], recursive := true) FROM x
 ) WHERE value <> '')"""


def own(text: str) -> str:
    """SQL of a piece of a message's text: every fifth message has separators of its own."""
    return f"CASE WHEN msg_id % 5 = 0 THEN translate({text}, '|^~&', '$*!@') ELSE {text} END"


def sql(body: str, *parts: str) -> str:
    """SQL over m, and over x and e where they are named; further parts come before the body."""
    out = [M]
    if "e" in parts or "x" in parts:
        out.append(X)
    if "e" in parts:
        out.append(E)
    out += [p for p in parts if p not in ("e", "x")]
    return "WITH " + ",\n".join(out) + "\n" + body


def local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A config table: a few fixed rows."""
    return spark.createDataFrame(rows, schema)


def types(spark: SparkSession) -> DataFrame:
    return local(spark, [(t,) for t in TYPES if t != "ORM"], "type string")
