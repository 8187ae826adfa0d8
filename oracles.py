"""SQL that computes each query's result on the test tables, for comparison.

Every text is one statement: a chain of named steps that ends in a selection.
The steps are written set by set in SQL and share nothing with the DataFrame
plans but the table definitions of ``FIXTURES.md``.
"""

from __future__ import annotations

import re

from emisplit.bridge import AE6, AE8, O2M_RATIOS, PM_SPECIES


def _values(rows, columns: str) -> str:
    def text(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) v({columns})"


def _div(a: str, b: str) -> str:
    """Integer quotient, halves rounded away from zero; ``b`` is positive."""
    return f"(sign({a}) * ((2 * abs({a}) + ({b})) // (2 * ({b}))))"


def _int(value: str, digits: int) -> str:
    """A decimal as an integer count of its last kept digit."""
    return f"CAST(CAST({value} AS DECIMAL(38,{digits})) * CAST(1{'0' * digits} AS HUGEINT) AS HUGEINT)"


def _real(value: str, digits: int) -> str:
    return f"CAST({value} AS DOUBLE) / 1e{digits}"


# Fixed-point numbers are integers in the steps below: a name ending in 8
# counts units of 1e-8, and so on. Every rounding is then exact.

# ---------------------------------------------------------------- test tables

PROFILES = """
profiles AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS profile_id, o_orderkey,
         'profile ' || o_orderkey || ' ' || o_orderpriority AS profile_name,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'GAS' WHEN '2' THEN 'GAS-VBS' WHEN '3' THEN 'PM'
              WHEN '4' THEN 'PM-AE6' WHEN '5' THEN 'PM-VBS' END AS profile_type,
         CASE WHEN o_orderkey % 10 = 0 THEN 10.0 ELSE 2.5 END AS upper_size,
         CASE o_orderstatus WHEN 'F' THEN 'Combustion' WHEN 'O' THEN 'Evaporation' END AS gen_mechanism,
         CASE o_custkey % 4 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'biomass burning'
              WHEN 2 THEN 'biomass burning boiler' END AS sec_equipment
  FROM orders)"""

SPECIES = """
species AS (
  SELECT CAST(p_partkey AS VARCHAR) AS specie_id, p_name AS specie_name,
         CAST(p_retailprice / 10 AS DECIMAL(20,12)) AS molecular_weight,
         (p_size % 10 = 0) AS non_voctog,
         CAST(CASE WHEN p_partkey % 97 = 0 THEN -99.0 WHEN p_partkey % 89 = 0 THEN 0.0
              ELSE p_retailprice / 10 END AS DECIMAL(20,12)) AS volatile_mw,
         CAST(CASE WHEN p_partkey % 13 = 0 THEN -99.0 WHEN p_partkey % 13 = 1 THEN 0.0
              ELSE pow(10.0, CAST(p_size AS DOUBLE) / 5 - 7) END AS DECIMAL(20,12)) AS vp_epi
  FROM part)"""

GAS_WEIGHTS = """
gas_quantity AS (
  SELECT l_orderkey, l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey, l_partkey),
gas_total AS (SELECT l_orderkey, sum(q) AS total FROM gas_quantity GROUP BY l_orderkey),
gas_weights AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS profile_id, CAST(l_partkey AS VARCHAR) AS specie_id,
         CAST(round(CAST(100 AS DOUBLE) * q / total * CASE WHEN l_orderkey % 7 = 0 THEN CAST(0.9 AS DOUBLE)
              WHEN l_orderkey % 11 = 0 THEN CAST(1.1 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END, 6) AS DECIMAL(12,6)) AS percent
  FROM gas_quantity JOIN gas_total USING (l_orderkey))"""

PM_WEIGHTS = f"""
pm_names AS (SELECT unnest({list(PM_SPECIES)!r}) AS specie_id, unnest(range({len(PM_SPECIES)})) AS position),
pm_quantity AS (
  SELECT l_orderkey, l_partkey % {len(PM_SPECIES)} AS position, sum(l_quantity) AS q
  FROM lineitem GROUP BY 1, 2),
pm_total AS (SELECT l_orderkey, sum(q) AS total FROM pm_quantity GROUP BY l_orderkey),
pm_weights AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS profile_id, specie_id,
         CAST(round(CAST(100 AS DOUBLE) * q / total
              * (CASE WHEN l_orderkey % 13 = 0 THEN CAST(1.2 AS DOUBLE) ELSE CAST(0.8 AS DOUBLE) END
                 * CASE WHEN position = 0 AND l_orderkey % 101 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END), 6)
              AS DECIMAL(12,6)) AS percent
  FROM pm_quantity JOIN pm_total USING (l_orderkey) JOIN pm_names USING (position)
  WHERE NOT (specie_id = '2669' AND CAST(l_orderkey AS VARCHAR) IN (SELECT profile_id FROM profiles WHERE profile_type = 'PM')))"""

MECHANISM = """
mechanism AS (
  SELECT m.mechanism, s.specie_id, s.aqm_poll, CAST(s.moles AS DECIMAL(20,12)) AS moles_per_mole
  FROM (SELECT CAST(p_partkey AS VARCHAR) AS specie_id, 'B' || regexp_extract(p_brand, '(\\d+)', 1) AS aqm_poll,
               CASE WHEN p_size % 25 = 0 THEN 0.0 ELSE 1 + 0.5 * (p_size % 3) END AS moles
        FROM part WHERE p_partkey % 9 <> 0
        UNION ALL
        SELECT CAST(p_partkey AS VARCHAR), 'XYL', 0.5 FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 4 = 0) s,
       (VALUES ('M_A'), ('M_B')) m(mechanism)),
carbons AS (
  SELECT m.mechanism, c.aqm_poll, CAST(c.n AS DECIMAL(5,2)) AS num_carbons
  FROM (SELECT DISTINCT 'B' || regexp_extract(p_brand, '(\\d+)', 1) AS aqm_poll,
               CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) % 8 + 1 AS n FROM part
        UNION ALL SELECT 'XYL', 8) c,
       (VALUES ('M_A'), ('M_B')) m(mechanism))"""

INVENTORY = """
toxic_parts AS (
  SELECT p_partkey, p_size FROM part
  WHERE p_type = 'PROMO' AND p_partkey % 3 = 0 AND p_partkey % 97 <> 0 AND p_partkey % 89 <> 0),
invtable AS (
  SELECT 'P' || p_partkey AS eminv_poll, '' AS mode, CAST(p_partkey AS VARCHAR) AS specie_id, 'Y' AS keep,
         CASE WHEN p_partkey % 2 = 0 THEN 'V' ELSE 'T' END AS voc, 'Y' AS model,
         CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS explicit FROM toxic_parts
  UNION ALL
  SELECT 'N' || n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'EXH' ELSE 'EVP' END, '0', 'N', 'N', 'N', 'N' FROM nation),
toxics AS (
  SELECT CAST(p_partkey AS VARCHAR) AS specie_id, 'T' || p_partkey AS aqm_poll,
         CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'T' END AS active FROM toxic_parts),
haps AS (SELECT DISTINCT specie_id, eminv_poll FROM invtable WHERE voc IN ('V', 'T')),
primary_rows AS (
  SELECT 'P' || p_partkey AS eminv_poll, 'X' || p_partkey AS aqm_add, CAST(0.5 AS DECIMAL(12,8)) AS split_factor,
         CASE WHEN p_partkey % 20 = 0 THEN 'Y' ELSE 'N' END AS writeflag
  FROM toxic_parts WHERE p_partkey % 10 = 0)"""

IVOC = """
ivoc_factors AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS profile_id,
         CASE o_orderkey % 9 WHEN 0 THEN 'IVOC_G' WHEN 3 THEN 'IVOC_D' ELSE 'IVOC_F' END AS ivoc_name,
         CAST(CASE o_orderkey % 9 WHEN 0 THEN 0.25 WHEN 3 THEN 0.2 ELSE 0.07 END AS DECIMAL(10,6)) AS nmogfraction
  FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('1', '2') AND o_orderkey % 3 = 0),
ivoc_species AS (
  SELECT * FROM (VALUES ('IVOC_G', 184.0), ('IVOC_D', 212.0), ('IVOC_F', 212.0)) v(specie_id, molwt))"""

# ---------------------------------------------------------------- gas steps

GAS_RAW = f"""
gas_raw AS (
  SELECT w.profile_id, w.specie_id, {_int("w.percent", 8)} AS p8
  FROM gas_weights w
  JOIN profiles p ON p.profile_id = w.profile_id AND p.profile_type IN ('GAS', 'GAS-VBS')
  JOIN species s ON s.specie_id = w.specie_id
  WHERE w.percent > 0 AND s.volatile_mw > 0),
gas_sums AS (SELECT profile_id, sum(p8) AS sum8 FROM gas_raw GROUP BY profile_id),
gas_norm AS (
  SELECT r.profile_id, r.specie_id, {_div("r.p8 * 10000000000", "s.sum8")} AS p8
  FROM gas_raw r JOIN gas_sums s USING (profile_id) WHERE s.sum8 BETWEEN 9500000000 AND 10500000000)"""

USER_RAW = f"""
user_weights AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS profile_id, CAST(l_partkey AS VARCHAR) AS specie_id,
         CAST(round(sum(l_quantity) / 10, 6) AS DECIMAL(10,6)) AS percent
  FROM lineitem GROUP BY l_suppkey, l_partkey),
user_raw AS (
  SELECT u.profile_id, u.specie_id, {_int("u.percent", 8)} AS p8
  FROM user_weights u JOIN species s USING (specie_id) WHERE u.percent > 0 AND s.volatile_mw > 0),
user_sums AS (SELECT profile_id, sum(p8) AS sum8 FROM user_raw GROUP BY profile_id),
gas_norm AS (
  SELECT r.profile_id, r.specie_id, {_div("r.p8 * 10000000000", "s.sum8")} AS p8
  FROM user_raw r JOIN user_sums s USING (profile_id)
  WHERE (s.sum8 BETWEEN 9000000000 AND 11000000000) OR r.profile_id NOT IN
        (SELECT profile_id FROM profiles WHERE profile_type IN ('GAS', 'GAS-VBS')))"""


def _mechanism_steps(mechanism: str) -> str:
    return f"""
run_rows AS (SELECT specie_id, aqm_poll, moles_per_mole FROM mechanism WHERE mechanism = '{mechanism}'),
run_carbons AS (SELECT aqm_poll, num_carbons FROM carbons WHERE mechanism = '{mechanism}'),
specie_moles AS (SELECT specie_id, sum(moles_per_mole) AS moles FROM run_rows GROUP BY specie_id),
unmapped AS (
  SELECT s.specie_id FROM species s LEFT JOIN specie_moles m USING (specie_id) WHERE m.moles IS NULL OR m.moles <= 0),
carbon_sums AS (
  SELECT r.specie_id, sum(r.moles_per_mole * c.num_carbons) AS n
  FROM run_rows r JOIN run_carbons c USING (aqm_poll) GROUP BY r.specie_id),
specie_carbons AS (
  SELECT s.specie_id, CASE WHEN c.n > 0 THEN {_int("c.n", 8)} ELSE 100000000 END AS c8
  FROM species s LEFT JOIN carbon_sums c USING (specie_id)),
base_mech AS (
  SELECT specie_id, aqm_poll, {_int("moles_per_mole", 8)} AS m8 FROM run_rows WHERE moles_per_mole > 0
  UNION ALL SELECT specie_id, 'UNK', 100000000 FROM unmapped)"""


_ALL_SPECIES = f"all_species AS (SELECT specie_id, {_int('volatile_mw', 12)} AS mw12, non_voctog FROM species)"

_PLAIN_TAIL = f"""
run_mech AS (SELECT * FROM base_mech),
model_carbons AS (SELECT aqm_poll, {_int("num_carbons", 8)} AS c8 FROM run_carbons UNION ALL SELECT 'UNK', 100000000),
all_carbons AS (SELECT * FROM specie_carbons),
{_ALL_SPECIES}"""

_TOXIC_CARBONS = f"""
model_carbons AS (
  SELECT aqm_poll, {_int("num_carbons", 8)} AS c8 FROM run_carbons
  UNION ALL SELECT t.aqm_poll, {_div("c.c8", "100000")} * 100000 FROM toxics t JOIN specie_carbons c USING (specie_id)
  UNION ALL SELECT 'UNK', 100000000),
all_carbons AS (SELECT * FROM specie_carbons),
{_ALL_SPECIES}"""

_INTEGRATE_TAIL = (
    """
run_mech AS (
  SELECT * FROM base_mech WHERE specie_id NOT IN (SELECT specie_id FROM toxics WHERE active = 'A')
  UNION ALL SELECT specie_id, aqm_poll, 100000000 FROM toxics),"""
    + _TOXIC_CARBONS
)

_NOINTEGRATE_TAIL = (
    """
run_mech AS (SELECT * FROM base_mech WHERE specie_id NOT IN (SELECT specie_id FROM toxics WHERE active = 'A')),"""
    + _TOXIC_CARBONS
)

_VBS_TAIL = f"""
run_mech AS (SELECT * FROM base_mech UNION ALL SELECT specie_id, specie_id, 100000000 FROM ivoc_species),
model_carbons AS (
  SELECT aqm_poll, {_int("num_carbons", 8)} AS c8 FROM run_carbons
  UNION ALL SELECT specie_id, 100000000 FROM ivoc_species UNION ALL SELECT 'UNK', 100000000),
all_carbons AS (SELECT * FROM specie_carbons UNION ALL SELECT specie_id, 100000000 FROM ivoc_species),
all_species AS (
  SELECT specie_id, {_int("volatile_mw", 12)} AS mw12, non_voctog FROM species
  UNION ALL SELECT specie_id, {_int("molwt", 12)}, false FROM ivoc_species)"""

_PLAIN_WEIGHTS = "prfwts AS (SELECT * FROM gas_norm)"

_INTEGRATE_WEIGHTS = f"""
no_haps AS (SELECT * FROM gas_norm WHERE specie_id NOT IN (SELECT specie_id FROM haps)),
no_hap_sums AS (SELECT profile_id, sum(p8) AS sum8 FROM no_haps GROUP BY profile_id),
prfwts AS (
  SELECT n.profile_id, n.specie_id, {_div("n.p8 * 10000000000", "s.sum8")} AS p8
  FROM no_haps n JOIN no_hap_sums s USING (profile_id))"""

_NOINTEGRATE_WEIGHTS = """
prfwts AS (
  SELECT * FROM gas_norm
  WHERE specie_id NOT IN (SELECT h.specie_id FROM haps h JOIN toxics t USING (specie_id) WHERE t.active = 'A'))"""

_VBS_WEIGHTS = f"""
nmog AS (
  SELECT profile_id, coalesce(sum(p8) FILTER (WHERE specie_id <> '529'), 0) AS total8 FROM gas_norm GROUP BY profile_id),
factors6 AS (SELECT profile_id, ivoc_name, {_int("nmogfraction", 6)} AS f6 FROM ivoc_factors),
prfwts AS (
  SELECT g.profile_id, g.specie_id,
         CASE WHEN f.profile_id IS NOT NULL AND g.specie_id <> '529'
              THEN {_div("(1000000 - f.f6) * g.p8", "1000000")} ELSE g.p8 END AS p8
  FROM gas_norm g LEFT JOIN factors6 f USING (profile_id)
  UNION ALL
  SELECT f.profile_id, f.ivoc_name, {_div("f.f6 * n.total8", "1000000")} FROM factors6 f JOIN nmog n USING (profile_id))"""

GAS_CALC = f"""
with_moles AS (
  SELECT w.profile_id, w.specie_id, w.p8, s.mw12, {_div("w.p8 * 10000000000", "s.mw12")} AS moles8
  FROM prfwts w JOIN all_species s USING (specie_id)),
mole_sums AS (SELECT profile_id, sum(moles8) AS total8 FROM with_moles GROUP BY profile_id),
with_share AS (
  SELECT m.*, {_div("m.moles8 * 100000000", "t.total8")} AS share8 FROM with_moles m JOIN mole_sums t USING (profile_id)),
byspc AS (
  SELECT w.profile_id, w.specie_id, r.aqm_poll, w.mw12,
         {_div("w.p8 * r.m8 * 100", "w.mw12")} AS per_gram8, {_div("w.share8 * r.m8", "100000000")} AS per_mole8
  FROM with_share w JOIN run_mech r USING (specie_id)),
byaqm AS (
  SELECT profile_id, aqm_poll, sum(per_gram8) AS grams8, sum(per_mole8) AS moles8
  FROM byspc GROUP BY profile_id, aqm_poll HAVING sum(per_gram8) > 0),
parts AS (
  SELECT b.profile_id, b.aqm_poll, {_div("b.mw12 * mc.c8 * 100", "sc.c8")} AS mass14,
         {_div("b.per_mole8 * 100000000", "a.moles8")} AS part8
  FROM byspc b JOIN byaqm a USING (profile_id, aqm_poll)
  JOIN model_carbons mc ON mc.aqm_poll = b.aqm_poll
  JOIN all_carbons sc ON sc.specie_id = b.specie_id),
avgmw AS (
  SELECT profile_id, aqm_poll, sum({_div("mass14 * part8", "100000000000000")}) AS avg8
  FROM parts GROUP BY profile_id, aqm_poll),
splits AS (
  SELECT profile_id, aqm_poll, {_div("grams8 * avg8", "1000000")} AS split10, avg8
  FROM byaqm JOIN avgmw USING (profile_id, aqm_poll))"""

_SPLIT_OUT = f"""{_real("split10", 10)} AS split_factor, {_real("avg8", 8)} AS divisor, {_real("split10", 10)} AS mass_fraction"""


def _with(*steps: str) -> str:
    return "WITH " + ",\n".join(s.strip() for s in steps)


def _gas(mechanism: str, tail: str, weights: str, *extra: str) -> str:
    return _with(
        PROFILES, SPECIES, GAS_WEIGHTS, MECHANISM, INVENTORY, IVOC, GAS_RAW, _mechanism_steps(mechanism), tail, weights,
        GAS_CALC, *extra,
    )


_VOC_ROWS = """SELECT DISTINCT '{scenario}' AS scenario_id, profile_id, 'VOC' AS eminv_poll, 'VOC' AS aqm_poll,
       CAST(1 AS DOUBLE) AS split_factor, CAST(1 AS DOUBLE) AS divisor, CAST(1 AS DOUBLE) AS mass_fraction FROM splits"""


def _split_rows(scenario: str, eminv: str, where: str = "true") -> str:
    return f"""SELECT '{scenario}' AS scenario_id, profile_id, '{eminv}' AS eminv_poll, aqm_poll, {_SPLIT_OUT}
FROM splits WHERE {where}"""


_ACTOX = """
actox AS (
  SELECT g.profile_id FROM gas_norm g JOIN toxics t USING (specie_id) WHERE t.active = 'A'
  GROUP BY g.profile_id HAVING sum(g.p8) >= 10000000000)"""


def _actox_rows(scenario: str, eminv: str) -> str:
    return f"""SELECT '{scenario}', profile_id, '{eminv}', 'VOC', CAST(0 AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)
FROM actox"""


_CNV = f"""
cnv_sums AS (
  SELECT r.profile_id, sum(r.p8) AS tog8, coalesce(sum(r.p8) FILTER (WHERE NOT s.non_voctog), 0) AS voc8
  FROM prfwts r LEFT JOIN all_species s USING (specie_id) GROUP BY r.profile_id),
cnv AS (
  SELECT profile_id, CASE WHEN voc8 = 0 THEN 0 ELSE {_div("tog8 * 10000000000", "greatest(voc8, 1)")} END AS factor10
  FROM cnv_sums)"""


def _cnv_rows(source: str, target: str) -> str:
    return f"""SELECT '{source}' AS from_specie, '{target}' AS to_specie, profile_id, {_real("factor10", 10)} AS cnv_factor
FROM cnv"""


_HAPLIST = f"""
hap_rows AS (
  SELECT h.specie_id, h.eminv_poll, r.aqm_poll, {_int("r.moles_per_mole", 8)} AS m8
  FROM haps h JOIN run_rows r USING (specie_id)
  WHERE r.moles_per_mole > 0 AND h.specie_id NOT IN (SELECT specie_id FROM toxics WHERE active = 'A')
  UNION ALL
  SELECT h.specie_id, h.eminv_poll || n.suffix, t.aqm_poll, 100000000
  FROM haps h JOIN toxics t USING (specie_id), (VALUES (''), ('_NOI')) n(suffix)
  WHERE (n.suffix = '' OR t.active = 'T')
    AND h.eminv_poll NOT IN (SELECT eminv_poll FROM primary_rows WHERE writeflag = 'Y')
  UNION ALL
  SELECT h.specie_id, p.eminv_poll || n.suffix, p.aqm_add, {_int("p.split_factor", 8)}
  FROM primary_rows p JOIN haps h USING (eminv_poll) JOIN toxics t USING (specie_id), (VALUES (''), ('_NOI')) n(suffix)
  WHERE n.suffix = '' OR t.active = 'T'),
hap_masses AS (
  SELECT r.*, {_div("r.m8 * 1000000000000", "s.mw12")} AS grams8,
         CASE WHEN r.aqm_poll IN (SELECT aqm_add FROM primary_rows UNION SELECT aqm_poll FROM toxics)
              THEN {_div("s.mw12", "10000")}
              ELSE {_div(_div("s.mw12 * mc.c8 * 100", "sc.c8"), "1000000")} END AS avg8
  FROM hap_rows r JOIN all_species s USING (specie_id)
  LEFT JOIN model_carbons mc ON mc.aqm_poll = r.aqm_poll
  LEFT JOIN all_carbons sc ON sc.specie_id = r.specie_id),
hap_splits AS (SELECT eminv_poll, aqm_poll, avg8, {_div("grams8 * avg8", "1000000")} AS split10 FROM hap_masses)"""

# ---------------------------------------------------------------- particulate steps

# Species dropped from AE6, and the ions, atoms and oxides of each element with the molar masses used.
_DROPPED = "'294','436','665','788','789','790','791','794','796','830','831','1183','1190'"

PM_TABLES = f"""
o2m AS ({_values([(s, round(r * 1000000)) for s, _, r in O2M_RATIOS], "specie_id, ratio6")}),
pm_mech AS ({_values([("AE6", *r) for r in AE6] + [("AE8", *r) for r in AE8], "mechanism, specie_id, aqm_poll")}),
svoc AS (
  SELECT profile_id, b.bin, {_int("b.fraction", 10)} AS bin10
  FROM (SELECT profile_id, unnest(range(5)) AS bin,
               unnest(CASE o_orderkey % 3 WHEN 0 THEN [0.03, 0.25, 0.37, 0.24, 0.11]
                      WHEN 1 THEN [0.27, 0.15, 0.26, 0.15, 0.17] ELSE [1.0, 0, 0, 0, 0] END) AS fraction
        FROM profiles WHERE profile_type LIKE 'PM%') b WHERE b.fraction <> 0)"""


# Ion, atom and oxide of each element, with the masses of element and oxide.
_PM_ELEMENTS = (
    ("2302", "669", None, None),
    ("785", "696", None, None),
    ("337", "795", None, None),
    ("2303", "329", "2847", (40, 56)),
    ("2772", "525", "2852", (24, 40)),
)


def _element_steps() -> list[str]:
    steps, last = [], "f_drop"
    for i, (ion, atom, oxide, ratio) in enumerate(_PM_ELEMENTS):
        members = ", ".join(f"'{s}'" for s in (ion, atom, oxide) if s)
        nonzero, name = f"f_nz{i}", f"f_el{i}"
        steps.append(f"{nonzero} AS (SELECT * FROM {last} WHERE NOT (specie_id IN ({members}) AND p8 = 0))")
        steps.append(f"ion{i} AS (SELECT profile_id FROM {nonzero} WHERE specie_id = '{ion}' AND p8 > 0)")
        steps.append(f"atom{i} AS (SELECT profile_id FROM {nonzero} WHERE specie_id = '{atom}' AND p8 > 0)")
        body = f"""SELECT r.profile_id, r.profile_type, CASE WHEN r.specie_id = '{atom}' AND r.p8 > 0
         AND x.profile_id IS NULL THEN '{ion}' ELSE r.specie_id END AS specie_id, r.p8
  FROM {nonzero} r LEFT JOIN (SELECT DISTINCT profile_id FROM ion{i}) x ON x.profile_id = r.profile_id"""
        if oxide:
            body += f"""
  UNION ALL
  SELECT r.profile_id, r.profile_type, '{ion}', {_div(f"r.p8 * {ratio[0]}", str(ratio[1]))}
  FROM {nonzero} r ANTI JOIN ion{i} x ON x.profile_id = r.profile_id ANTI JOIN atom{i} y ON y.profile_id = r.profile_id
  WHERE r.specie_id = '{oxide}' AND r.p8 > 0"""
        steps.append(f"{name} AS ({body})")
        last = name
    # The atoms and oxides that ions replace.
    steps.append(
        f"f_atoms AS (SELECT * FROM {last} WHERE specie_id NOT IN ('329','525','669','696','795','2847','2852'))"
    )
    return steps


# Gap filling step by step; the rows of one step feed the next and are worked out once.
PM_FILL = ",\n".join(
    re.sub(r"^(\w+) AS \(", r"\1 AS MATERIALIZED (", step)
    for step in [
        f"""pm_raw AS (
  SELECT w.profile_id, p.profile_type, w.specie_id, {_int("w.percent", 8)} AS p8
  FROM pm_weights w JOIN profiles p USING (profile_id)
  WHERE p.profile_type IN ('PM', 'PM-AE6', 'PM-VBS') AND p.upper_size = 2.5)""",
        """f_so4 AS (
  SELECT * FROM pm_raw UNION ALL
  SELECT r.profile_id, r.profile_type, '699', r.p8 * 3 FROM pm_raw r
  ANTI JOIN (SELECT profile_id FROM pm_raw WHERE specie_id = '699') x ON x.profile_id = r.profile_id
  WHERE r.specie_id = '700')""",
        f"""f_h2o AS (
  SELECT * FROM f_so4 UNION ALL
  SELECT * FROM (
    SELECT r.profile_id, r.profile_type, '2668', {_div("sum(r.p8) * 24", "100")} AS p8
    FROM f_so4 r JOIN profiles p ON p.profile_id = r.profile_id
    ANTI JOIN (SELECT profile_id FROM f_so4 WHERE specie_id = '2668') x ON x.profile_id = r.profile_id
    WHERE r.profile_type = 'PM' AND r.specie_id IN ('699', '784') AND coalesce(p.gen_mechanism, '') <> 'Combustion'
    GROUP BY r.profile_id, r.profile_type) WHERE p8 <> 0)""",
        """mo_parts AS (
  SELECT r.profile_id, r.profile_type, coalesce(sum(r.p8 * CAST(o.ratio6 AS HUGEINT)), 0) AS metal14,
         coalesce(sum(r.p8) FILTER (WHERE r.specie_id = '784'), 0) AS ammonium8,
         sum(r.p8) FILTER (WHERE r.specie_id = '699') AS sulfate8
  FROM f_h2o r LEFT JOIN o2m o USING (specie_id) WHERE r.profile_type = 'PM' GROUP BY r.profile_id, r.profile_type)""",
        f"""f_mo AS (
  SELECT * FROM f_h2o UNION ALL
  SELECT profile_id, profile_type, '2670',
         CASE WHEN coalesce(3 * sulfate8 - 8 * ammonium8, 0) <= 0 THEN {_div("metal14", "1000000")}
              ELSE {_div("greatest(18 * metal14 - (3 * sulfate8 - 8 * ammonium8) * 1000000, 0)", "18000000")} END
  FROM mo_parts)""",
        f"""f_om AS (
  SELECT * FROM f_mo UNION ALL
  SELECT r.profile_id, r.profile_type, '2669', {_div("r.p8 * p.factor100", "100")}
  FROM f_mo r JOIN (
    SELECT profile_id, CASE WHEN sec_equipment LIKE '%biomass burning%' AND sec_equipment NOT LIKE '%boiler%' THEN 70
           WHEN gen_mechanism = 'Combustion' AND sec_equipment LIKE '%Mobile%' THEN 25 ELSE 40 END AS factor100
    FROM profiles) p USING (profile_id) WHERE r.profile_type = 'PM' AND r.specie_id = '626')""",
        f"f_drop AS (SELECT * FROM f_om WHERE specie_id NOT IN ({_DROPPED}))",
        *_element_steps(),
        """ae6 AS (
  SELECT profile_id, sum(p8) FILTER (WHERE specie_id <> '700') AS total8,
         coalesce(sum(p8) FILTER (WHERE specie_id IN ('626', '2669')), 0) AS om8
  FROM f_atoms WHERE profile_type = 'PM' GROUP BY profile_id
  HAVING sum(p8) FILTER (WHERE specie_id <> '700') > 10100000000),
ae6_room AS (SELECT *, 10000000000 - (total8 - om8) AS room8 FROM ae6)""",
        f"""filled AS (
  SELECT r.profile_id, r.profile_type, r.specie_id, CASE
         WHEN a.profile_id IS NULL THEN r.p8
         WHEN a.om8 > 0 AND a.room8 > 0 AND r.specie_id IN ('626', '2669') THEN {_div("r.p8 * a.room8", "greatest(a.om8, 1)")}
         WHEN a.om8 > 0 AND a.room8 > 0 THEN r.p8
         ELSE {_div("r.p8 * 10000000000", "a.total8")} END AS p8
  FROM f_atoms r LEFT JOIN ae6_room a USING (profile_id))""",
    ]
)


def _pm_fractions(mechanism: str) -> str:
    types = "'PM', 'PM-AE6', 'PM-VBS'" if mechanism == "AE8" else "'PM', 'PM-AE6'"
    return f"""
matched AS (
  SELECT f.profile_id, f.profile_type, m.aqm_poll, f.p8 FROM filled f
  JOIN pm_mech m ON m.specie_id = f.specie_id AND m.mechanism = '{mechanism}' WHERE f.profile_type IN ({types})),
mech_sums AS (SELECT profile_id, profile_type, sum(p8) AS sum8 FROM matched GROUP BY ALL),
under_100 AS (SELECT * FROM mech_sums WHERE sum8 < 10100000000 OR profile_type = 'PM-VBS'),
negative AS (SELECT DISTINCT profile_id FROM filled WHERE p8 < 0),
kept_sums AS (SELECT * FROM under_100 WHERE profile_id NOT IN (SELECT profile_id FROM negative)),
base_fractions AS (
  SELECT m.profile_id, m.aqm_poll, m.p8 AS f10 FROM matched m JOIN kept_sums k USING (profile_id)
  UNION ALL
  SELECT profile_id, 'PMOTHR', 10000000000 - sum8 FROM kept_sums WHERE sum8 < 10000000000)"""


# The model species that CAMx sums, keeps and renames.
_CAMX = f"""
camx_fractions AS (
  SELECT profile_id, 'POA' AS aqm_poll, {_div("sum(f10)", "100")} * 100 AS f10
  FROM base_fractions WHERE aqm_poll IN ('PNCOM', 'POC') GROUP BY profile_id
  UNION ALL
  SELECT profile_id, CASE WHEN CAST(profile_id AS BIGINT) % 8 = 0 THEN 'FCRS' ELSE 'FPRM' END, {_div("sum(f10)", "100")} * 100
  FROM base_fractions WHERE aqm_poll IN ('PFE','PAL','PSI','PTI','PCA','PMG','PK','PMN','PMOTHR') GROUP BY profile_id
  UNION ALL
  SELECT profile_id, CASE aqm_poll WHEN 'PNA' THEN 'NA' ELSE aqm_poll END, f10 FROM base_fractions
  WHERE aqm_poll IN ('PEC','PH2O','PNH4','PSO4','PNO3','PCL','POC','PNA'))"""

_CMAQ_VBS = f"""
organics AS (
  SELECT profile_id, {_div("sum(f10)", "100")} AS o8 FROM base_fractions
  WHERE aqm_poll IN ('PNCOM', 'POC') GROUP BY profile_id),
vbs_fractions AS (
  SELECT * FROM base_fractions WHERE aqm_poll NOT IN ('PNCOM', 'POC')
  UNION ALL
  SELECT o.profile_id, 'P_PVB' || s.bin, {_div("o.o8 * s.bin10", "100000000")}
  FROM organics o JOIN svoc s USING (profile_id))"""

_CAMX_VBS = (
    _CAMX
    + f""",
vbs_fractions AS (
  SELECT * FROM camx_fractions WHERE aqm_poll <> 'POA'
  UNION ALL
  SELECT c.profile_id, 'PAP' || s.bin, {_div("c.f10 * s.bin10", "10000000000")}
  FROM camx_fractions c JOIN svoc s USING (profile_id) WHERE c.aqm_poll = 'POA')"""
)


def _pm(mechanism: str, *extra: str) -> str:
    return _with(PROFILES, PM_WEIGHTS, PM_TABLES, PM_FILL, _pm_fractions(mechanism), *extra)


def _fraction_rows(scenario: str, table: str) -> str:
    return f"""SELECT '{scenario}' AS scenario_id, profile_id, 'PM2_5' AS eminv_poll, aqm_poll,
       {_real("f10", 10)} AS split_factor, CAST(1 AS DOUBLE) AS divisor, {_real("f10", 10)} AS mass_fraction FROM {table}"""


# ---------------------------------------------------------------- scenario table

_RUNS = """runs AS (
  SELECT *, coalesce(output LIKE '%VOC%', true) AS gas, coalesce(output LIKE '%PM%', false) AS pm FROM (
    SELECT c_name,
           CASE c_custkey % 4 WHEN 1 THEN 'M_A' WHEN 2 THEN 'AE6' WHEN 3 THEN 'M_B' END AS mech,
           CASE c_nationkey % 6 WHEN 1 THEN 'CRITERIA' WHEN 2 THEN 'VBS' WHEN 3 THEN 'HAPLIST' WHEN 4 THEN 'INTEGRATE'
                WHEN 5 THEN 'NOINTEGRATE' END AS kind,
           CASE c_custkey % 5 WHEN 1 THEN 'CMAQ' WHEN 2 THEN 'CMAQ' WHEN 3 THEN 'CAMX' WHEN 4 THEN 'CAMX' END AS aqm,
           CASE c_nationkey % 5 WHEN 1 THEN 'VOC' WHEN 2 THEN 'PM' WHEN 3 THEN 'STATIC' WHEN 4 THEN 'VOC+PM' END AS output,
           CASE WHEN c_custkey % 7 = 0 THEN 'own.csv' END AS pro,
           CASE WHEN c_custkey % 11 = 0 THEN 'modes.csv' END AS proc
    FROM customer))"""

# ---------------------------------------------------------------- statements

_TABLES = _with(PROFILES, SPECIES, GAS_WEIGHTS, MECHANISM, INVENTORY, IVOC, GAS_RAW)
_PLAIN = _gas("M_A", _PLAIN_TAIL, _PLAIN_WEIGHTS)
_CNV_PLAIN = _gas("M_A", _PLAIN_TAIL, _PLAIN_WEIGHTS, _CNV)


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["gas_renormalised_weights"] = _TABLES + f"""
SELECT profile_id, specie_id, {_real("p8", 8)} AS percent FROM gas_norm"""
    sql["gas_unmapped_species"] = _with(PROFILES, SPECIES, MECHANISM, _mechanism_steps("M_A")) + """
SELECT 'crit' AS scenario_id, specie_id FROM unmapped"""
    sql["gas_species_carbons"] = _with(PROFILES, SPECIES, MECHANISM, _mechanism_steps("M_A")) + f"""
SELECT 'crit' AS scenario_id, specie_id, {_real("c8", 8)} AS num_carbons FROM specie_carbons"""
    sql["gas_moles_per_gram"] = _PLAIN + f"""
SELECT 'crit' AS scenario_id, profile_id, specie_id, aqm_poll, {_real("per_gram8", 8)} AS moles_per_gram,
       {_real("per_mole8", 8)} AS moles_per_mole_em FROM byspc"""
    sql["gas_model_species"] = _PLAIN + f"""
SELECT 'crit' AS scenario_id, profile_id, aqm_poll, {_real("grams8", 8)} AS moles_per_gram, {_real("avg8", 8)} AS avg_mw
FROM byaqm JOIN avgmw USING (profile_id, aqm_poll)"""
    sql["gas_split_factors"] = (
        _PLAIN + "\n" + _split_rows("crit", "TOG") + "\nUNION ALL\n" + _VOC_ROWS.format(scenario="crit")
    )
    user = _with(PROFILES, SPECIES, MECHANISM, USER_RAW, _mechanism_steps("M_B"), _PLAIN_TAIL, _PLAIN_WEIGHTS, GAS_CALC)
    sql["gas_user_weights_splits"] = user + "\n" + _split_rows("user", "TOG", "aqm_poll NOT IN ('UNK', 'NONSOA')")
    sql["gas_voc_to_tog"] = _CNV_PLAIN + "\n" + _cnv_rows("VOC", "TOG")
    sql["gas_voc_to_tog_modes"] = (
        _CNV_PLAIN + "\n" + _cnv_rows("VOC", "TOG") + """
UNION ALL
SELECT g.process || '__VOC', g.process || '__TOG', c.profile_id, c.factor10 / 1e10
FROM cnv c JOIN (SELECT profile_id, CASE WHEN o_orderkey % 2 = 0 THEN 'EXH' ELSE 'EVP' END AS process
                 FROM profiles WHERE profile_type = 'GAS') g USING (profile_id)
WHERE g.process IN (SELECT mode FROM invtable)"""
    )
    integrate = _gas("M_A", _INTEGRATE_TAIL, _INTEGRATE_WEIGHTS, _ACTOX)
    sql["gas_integrate_splits"] = (
        integrate + "\n" + _split_rows("integrate", "NONHAPTOG") + "\nUNION ALL\n" + _actox_rows("integrate", "NONHAPTOG")
    )
    sql["gas_integrate_cnv"] = (
        _gas("M_A", _INTEGRATE_TAIL, _INTEGRATE_WEIGHTS, _CNV) + """
SELECT 'NONHAPVOC' AS from_specie, 'NONHAPTOG' AS to_specie, profile_id,
       CAST(coalesce(c.factor10, 0) AS DOUBLE) / 1e10 AS cnv_factor
FROM (SELECT DISTINCT profile_id FROM gas_norm) g LEFT JOIN cnv c USING (profile_id)"""
    )
    sql["gas_integrate_header"] = _with(INVENTORY) + """
SELECT 'integrate' AS scenario_id,
       CASE WHEN mode = '' THEN eminv_poll ELSE mode || '__' || eminv_poll END AS aqminv_poll
FROM invtable WHERE voc IN ('V', 'T')"""
    sql["gas_actox_profiles"] = _TABLES + "," + _ACTOX + "\nSELECT profile_id FROM actox"
    sql["gas_nointegrate_splits"] = (
        _gas("M_A", _NOINTEGRATE_TAIL, _NOINTEGRATE_WEIGHTS, _ACTOX)
        + "\n" + _split_rows("nointegrate", "TOG") + "\nUNION ALL\n" + _actox_rows("nointegrate", "TOG")
    )
    sql["haplist_splits"] = _gas("M_A", _INTEGRATE_TAIL, _PLAIN_WEIGHTS, _HAPLIST) + f"""
SELECT 'haplist' AS scenario_id, '0000' AS profile_id, eminv_poll, aqm_poll, {_SPLIT_OUT} FROM hap_splits"""
    vbs = _gas("M_A", _VBS_TAIL, _VBS_WEIGHTS, _CNV)
    sql["gas_vbs_splits"] = vbs + "\n" + _split_rows("vbs", "TOG") + "\nUNION ALL\n" + _VOC_ROWS.format(scenario="vbs")
    sql["gas_vbs_voc_to_tog"] = vbs + "\n" + _cnv_rows("VOC", "TOG")
    sql["volatility_class"] = _with(SPECIES) + """
SELECT specie_id, specie_name, CASE
  WHEN vp_epi > 0 THEN CASE WHEN c < -0.5 THEN 'SVOCN1' WHEN c < 0.5 THEN 'SVOCP0' WHEN c < 1.5 THEN 'SVOCP1'
    WHEN c < 2.5 THEN 'SVOCP2' WHEN c < 3.5 THEN 'IVOCP3' WHEN c < 4.5 THEN 'IVOCP4' WHEN c < 5.5 THEN 'IVOCP5'
    WHEN c < 6.5 THEN 'IVOCP6' ELSE 'VOC' END
  WHEN vp_epi = 0 THEN 'SVOCN1' ELSE ' ' END AS voc_class
FROM (SELECT *, CASE WHEN vp_epi > 0 THEN log10(CAST(molecular_weight AS DOUBLE) * CAST(vp_epi AS DOUBLE) * 1000000
        / CAST(133.3223684 AS DOUBLE) / 760 / CAST(0.0000821 AS DOUBLE) / CAST(298.15 AS DOUBLE)) END AS c FROM species)"""

    sql["pm_gap_filled_weights"] = _with(PROFILES, PM_WEIGHTS, PM_TABLES, PM_FILL) + f"""
SELECT profile_id, profile_type, specie_id, {_real("p8", 8)} AS percent FROM filled"""
    sql["pm_fractions"] = _pm("AE6") + "\n" + _fraction_rows("ae6", "base_fractions")
    sql["pm_ae8_fractions"] = _pm("AE8") + "\n" + _fraction_rows("ae8", "base_fractions")
    sql["pm_camx_fractions"] = _pm("AE6", _CAMX) + "\n" + _fraction_rows("camx", "camx_fractions")
    sql["pm_vbs_fractions"] = _pm("AE6", _CMAQ_VBS) + "\n" + _fraction_rows("pmvbs", "vbs_fractions")
    sql["pm_camx_vbs_fractions"] = _pm("AE6", _CAMX_VBS) + "\n" + _fraction_rows("pmvbscamx", "vbs_fractions")
    sql["pm_svoc_bins"] = _with(PROFILES, PM_TABLES) + """
SELECT profile_id, 'P_PVB' || bin AS bin_poll, CAST(bin10 AS DOUBLE) / 1e10 AS bin_fraction FROM svoc"""

    static = """
static_rows AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS profile_id, 'S' || n_regionkey AS eminv_poll, c.aqm_poll, c.split
  FROM nation, (VALUES ('A0', 1.0), ('A1', 0.5)) c(aqm_poll, split))"""
    renamed = "CASE aqm_poll WHEN 'B1' THEN 'BONE' WHEN 'B2' THEN 'BTWO' ELSE aqm_poll END"
    sql["static_renamed_splits"] = _gas("M_A", _PLAIN_TAIL, _PLAIN_WEIGHTS, static) + f"""
SELECT 'static' AS scenario_id, profile_id, 'TOG' AS eminv_poll, {renamed} AS aqm_poll, {_SPLIT_OUT} FROM splits
UNION ALL {_VOC_ROWS.format(scenario="static")}
UNION ALL SELECT 'static', profile_id, eminv_poll, aqm_poll, CAST(split AS DOUBLE), CAST(1 AS DOUBLE), CAST(split AS DOUBLE)
FROM static_rows"""
    sql["profile_summary"] = _PLAIN + """
SELECT 'crit' AS scenario_id, count(DISTINCT profile_id) AS profiles FROM splits"""

    sql["process_modes"] = """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS profile_id,
       CASE WHEN o_orderkey % 2 = 0 THEN 'EXH' ELSE 'EVP' END AS process
FROM orders WHERE o_orderstatus <> 'P' AND o_custkey % 3 <> 2"""
    sql["clean_text"] = r"""
SELECT doc_id, regexp_replace(text, '[^\x20-\x7E\n]', '', 'g') AS clean FROM documents"""
    sql["invtable_lines"] = _with(INVENTORY) + """
SELECT eminv_poll, mode, specie_id, keep, voc, model, explicit FROM invtable"""
    sql["csv_weights"] = _with(PROFILES, SPECIES, GAS_WEIGHTS) + """
SELECT profile_id, specie_id, CAST(percent AS DOUBLE) AS percent FROM gas_weights"""
    sql["plain_process"] = _with(PROFILES) + """
SELECT profile_id, CASE WHEN o_orderkey % 2 = 0 THEN 'EXH' ELSE 'EVP' END AS process
FROM profiles WHERE profile_type = 'GAS'"""
    sql["duplicate_weights"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS profile_id, CAST(l_partkey AS VARCHAR) AS specie_id, count(*) AS copies
FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1"""
    sql["control_runs"] = """
SELECT c_name AS run_name, 'M_' || upper(substr(c_mktsegment, 1, 1)) AS mechanism, 'CRITERIA' AS run_type,
       'CMAQ' AS aqm, CAST(c_nationkey AS VARCHAR) AS tolerance FROM customer"""

    sql["loaded_weights"] = sql["csv_weights"]
    sql["load_report"] = _with(GAS_WEIGHTS) + """,
given AS (
  SELECT profile_id, specie_id, percent, CAST(profile_id AS BIGINT) AS o FROM gas_weights)
SELECT 'profile_weights' AS "table", true AS has_line, 'expected 7 fields' AS problem,
       profile_id || ',' || specie_id || ',' || percent AS text FROM given, range(CASE WHEN o % 60 = 3 THEN 3 ELSE 1 END)
WHERE o % 75 = 2
UNION ALL
SELECT 'profile_weights', true, 'percent is no decimal(12,6): x' || percent,
       profile_id || ',' || specie_id || ',x' || percent || ',0.5,,,' FROM given WHERE o % 75 <> 2 AND o % 50 = 1
UNION ALL
SELECT 'profile_weights', false, '3 rows with one key', profile_id || ',' || specie_id FROM given
WHERE o % 75 <> 2 AND o % 50 <> 1 AND o % 60 = 3"""
    sql["metadata_sources"] = """
SELECT CAST(page_id AS VARCHAR) AS keyword, regexp_replace(url, '^[^/]*/', '') AS dataval FROM pages"""
    sql["required_settings"] = f"""
WITH {_RUNS}
SELECT c_name AS scenario_id, 'AQM' AS setting FROM runs WHERE aqm IS NULL
UNION ALL SELECT c_name, 'MECH_BASIS' FROM runs WHERE mech IS NULL AND coalesce(output, 'VOC') IN ('VOC', 'PM')
UNION ALL SELECT c_name, 'RUN_TYPE' FROM runs WHERE kind IS NULL AND coalesce(output, 'VOC') = 'VOC'"""
    sql["pm_run_types"] = f"""
WITH {_RUNS}
SELECT c_name AS scenario_id, kind FROM runs
WHERE output LIKE '%PM%' AND coalesce(kind, '') NOT IN ('CRITERIA', 'VBS')"""
    sql["header_rows"] = f"""
WITH {_RUNS},
header AS (
  SELECT * FROM (VALUES ('AQM', NULL), ('MECH', NULL), ('RUN_TYPE', NULL), ('PROCESS', NULL), ('INVTABLE', 'part.parquet'),
    ('PROFILES', 'lineitem.parquet'), ('CARBONS', 'part.parquet'), ('STATIC', 'nation.parquet'), ('GAS_PROFILES', 'gas.csv'),
    ('PM_PROFILES', 'pm.csv'), ('CAMX_FCRS', 'fcrs.lst'), ('VBS_IVOC_FACTORS', 'ivoc.csv'), ('VBS_SVOC_FACTORS', 'svoc.csv')
  ) v(keyword, source)),
-- As the settings are worked through one after the other, the last rule that applies wins.
said AS (
  SELECT c_name, keyword, 'Not Applicable' AS dataval, 0 AS step FROM runs, header
  UNION ALL SELECT c_name, 'AQM', aqm, 1 FROM runs
  UNION ALL SELECT c_name, 'MECH', mech, 1 FROM runs
  UNION ALL SELECT c_name, keyword, source, 1 FROM runs, header WHERE keyword = 'INVTABLE'
  UNION ALL SELECT c_name, 'RUN_TYPE', kind, 1 FROM runs WHERE gas
  UNION ALL SELECT c_name, keyword, coalesce(pro, source), 1 FROM runs, header
    WHERE keyword = 'GAS_PROFILES' AND gas AND coalesce(kind, '') <> 'HAPLIST'
  UNION ALL SELECT c_name, keyword, source, 1 FROM runs, header WHERE keyword = 'CARBONS' AND gas
  UNION ALL SELECT c_name, keyword, source, 1 FROM runs, header WHERE keyword = 'VBS_IVOC_FACTORS' AND gas AND kind = 'VBS'
  UNION ALL SELECT c_name, 'RUN_TYPE', coalesce(kind, 'CRITERIA'), 2 FROM runs WHERE pm
  UNION ALL SELECT c_name, keyword, source, 1 FROM runs, header WHERE keyword = 'PM_PROFILES' AND pm
  UNION ALL SELECT c_name, keyword, source, 1 FROM runs, header WHERE keyword = 'CAMX_FCRS' AND pm AND mech = 'AE6' AND aqm = 'CAMX'
  UNION ALL SELECT c_name, keyword, source, 1 FROM runs, header WHERE keyword = 'VBS_SVOC_FACTORS' AND pm AND kind = 'VBS'
  UNION ALL SELECT c_name, keyword, source, 1 FROM runs, header WHERE keyword = 'STATIC' AND output LIKE '%STATIC%'
  UNION ALL SELECT c_name, 'PROCESS', proc, 1 FROM runs WHERE gas AND proc IS NOT NULL)
SELECT c_name AS scenario_id, keyword, arg_max(struct_pack(v := dataval), step).v AS dataval FROM said GROUP BY c_name, keyword
UNION ALL
SELECT c_name, 'NOTE', 'PM CAMx CF carries additional POC compound for model performance evaluation' FROM runs
WHERE pm AND mech = 'AE6' AND aqm = 'CAMX'
UNION ALL
SELECT c_name, 'NOTE', 'unknown species are not written' FROM runs WHERE mech = 'M_B'"""
    sql["quality_pm_mechanism"] = """
SELECT p_brand AS scenario_id, count(*) FILTER (WHERE p_partkey % 7 = 0 AND p_size < 5) AS computed
FROM part GROUP BY p_brand HAVING count(*) FILTER (WHERE p_partkey % 7 = 0 AND p_size < 5) <> 1"""
    sql["empty_outputs"] = """
SELECT CAST(n_nationkey AS VARCHAR) AS scenario_id FROM nation
WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)"""

    sql["quality_tolerance"] = _TABLES + """
SELECT s.profile_id, CAST(s.sum8 AS DOUBLE) / 1e8 AS sum_pct, substr(p.profile_name, 1, 50) AS profile_name
FROM gas_sums s JOIN profiles p USING (profile_id) WHERE s.sum8 NOT BETWEEN 9500000000 AND 10500000000"""
    sql["quality_missing_mw"] = _with(PROFILES, SPECIES, GAS_WEIGHTS) + """
SELECT w.profile_id, w.specie_id, CAST(w.percent AS DOUBLE) AS percent
FROM gas_weights w JOIN profiles p ON p.profile_id = w.profile_id AND p.profile_type IN ('GAS', 'GAS-VBS')
JOIN species s ON s.specie_id = w.specie_id WHERE w.percent > 0 AND (s.volatile_mw IS NULL OR s.volatile_mw <= 0)"""
    sql["quality_over_100"] = _pm("AE8") + """
SELECT 'ae8' AS scenario_id, profile_id, CAST(sum8 AS DOUBLE) / 1e8 AS sum_pct FROM mech_sums
WHERE sum8 >= 10100000000 AND profile_type <> 'PM-VBS'"""
    sql["quality_negative"] = _pm("AE8") + """
SELECT 'ae8' AS scenario_id, f.profile_id, f.specie_id, CAST(f.p8 AS DOUBLE) / 1e8 AS percent
FROM filled f JOIN under_100 u USING (profile_id) WHERE f.p8 < 0"""
    sql["quality_unmapped_in_profiles"] = _PLAIN + """
SELECT 'crit' AS scenario_id, specie_id, specie_name FROM unmapped JOIN species USING (specie_id)
WHERE specie_id IN (SELECT specie_id FROM gas_norm)"""
    sql["quality_missing_carbons"] = _with(MECHANISM) + """
SELECT DISTINCT 'crit' AS scenario_id, aqm_poll FROM mechanism
WHERE mechanism = 'M_A' AND aqm_poll NOT IN (
  SELECT 'B' || s_nationkey FROM supplier)"""
    sql["quality_name_width"] = """
SELECT DISTINCT p_name AS eminv_poll FROM part
WHERE (p_size > 25 AND length(p_name) > 7) OR (p_size <= 25 AND length(p_name) > 11)"""
    sql["quality_name_width_pm"] = """
SELECT DISTINCT p_name AS eminv_poll FROM part
WHERE (p_size <= 25 AND length(p_name) > 7) OR (p_size > 25 AND length(p_name) > 12)"""
    sql["quality_toxics_cover"] = _with(INVENTORY) + """
SELECT DISTINCT specie_id FROM invtable WHERE voc IN ('V', 'T') AND keep = 'Y' AND model = 'Y' AND specie_id NOT IN (
  SELECT CAST(o_custkey AS VARCHAR) FROM orders)"""
    sql["quality_unclassified_toxics"] = """
SELECT CAST(p_partkey AS VARCHAR) AS specie_id, 'T' || p_partkey AS aqm_poll FROM part
WHERE p_type <> 'PROMO' OR p_partkey % 3 <> 0 OR p_partkey % 97 = 0 OR p_partkey % 89 = 0"""
    sql["quality_hap_mw"] = _with(SPECIES) + """
SELECT specie_id, CAST(volatile_mw AS DOUBLE) AS volatile_mw FROM species
WHERE volatile_mw <= 0 AND specie_id IN (SELECT CAST(l_partkey AS VARCHAR) FROM lineitem)"""
    sql["quality_pm_species"] = _with(SPECIES, PROFILES, PM_TABLES) + """
SELECT 'ae8' AS scenario_id, specie_id, aqm_poll FROM pm_mech
WHERE mechanism = 'AE8' AND specie_id NOT IN (SELECT specie_id FROM species)"""
    sql["quality_svoc_cover"] = _with(PROFILES) + """
SELECT p.profile_id, p.profile_type FROM profiles p ANTI JOIN lineitem l ON l.l_orderkey = p.o_orderkey
WHERE p.profile_type LIKE 'PM%'"""
    sql["quality_svoc_sum"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS profile_id,
       round(CAST(0.5 AS DOUBLE) + CASE WHEN o_orderstatus = 'F' THEN 0.5 ELSE 0.4 END, 6) AS bin_sum
FROM orders WHERE o_orderstatus <> 'F'"""

    meta = """
meta AS (
  SELECT * FROM (VALUES ('AQM', 'CMAQ'), ('MECH', 'M_A'), ('RUN_TYPE', 'INTEGRATE'), ('PROCESS', 'Not Applicable'),
    ('INVTABLE', 'part.parquet'), ('PROFILES', 'Not Applicable'), ('CARBONS', 'part.parquet'),
    ('STATIC', 'Not Applicable')) v(keyword, dataval))"""
    meta_rows = """SELECT 'integrate' AS scenario_id, 0 AS section,
       printf('%-20s %s %s', '#' || keyword, dataval, '') AS line FROM meta"""
    names = "'%-20s %-20s %-10s ', profile_id, 'NONHAPTOG', aqm_poll"
    sql["gspro_lines"] = integrate + "," + meta + f"""
{meta_rows}
UNION ALL
SELECT 'integrate', 1, printf('%-15s %-20s', '#NHAP NONHAPTOG',
       CASE WHEN mode = '' THEN eminv_poll ELSE mode || '__' || eminv_poll END)
FROM invtable WHERE voc IN ('V', 'T')
UNION ALL
SELECT 'integrate', 2, printf({names}) || CASE WHEN split >= 0.0099
       THEN printf('%12.6f %12.6f %12.6f', split, divisor, split)
       ELSE printf('%.6e %12.6f %.6e', split, divisor, split) END
FROM (SELECT profile_id, aqm_poll, {_real("split10", 10)} AS split, {_real("avg8", 8)} AS divisor FROM splits
      UNION ALL SELECT profile_id, 'VOC', 0, 1 FROM actox)"""
    sql["gscnv_lines"] = _gas("M_A", _INTEGRATE_TAIL, _INTEGRATE_WEIGHTS, _CNV, meta) + f"""
{meta_rows}
UNION ALL
SELECT 'integrate', 2, printf('%-20s %-20s %-20s %12.8f ', 'NONHAPVOC', 'NONHAPTOG', profile_id,
       CAST(coalesce(c.factor10, 0) AS DOUBLE) / 1e10)
FROM (SELECT DISTINCT profile_id FROM gas_norm) g LEFT JOIN cnv c USING (profile_id)"""
    sql["gspro_files"] = f"SELECT scenario_id, line FROM ({sql['gspro_lines']})"
    sql["volatility_lines"] = (
        f"SELECT specie_id || chr(9) || specie_name || chr(9) || voc_class AS line FROM ({sql['volatility_class']})"
    )

    # All findings of one run: severity, check, the keys and value that its rows have, message.
    findings = [
        ("ERROR", "name_width_gas", "quality_name_width", "", "'inventory name too long for an output name: ' || eminv_poll"),
        ("ERROR", "carbons", "quality_missing_carbons", "aqm_poll", "'model species without carbon number'"),
        ("WARNING", "unmapped_species", "gas_unmapped_species", "specie_id", "'mechanism undefined; set to UNK if referenced'"),
        (
            "WARNING", "missing_mw", "quality_missing_mw", "profile_id specie_id percent",
            "'component dropped: no molecular weight'",
        ),
        (
            "WARNING", "tolerance", "quality_tolerance", "profile_id sum_pct",
            "concat_ws(' ', 'profile dropped: total percent out of tolerance', profile_name)",
        ),
        (
            "WARNING", "unmapped_in_profiles", "quality_unmapped_in_profiles", "specie_id",
            "concat_ws(' ', 'mechanism undefined, used by profiles:', specie_name)",
        ),
    ]

    def found(severity: str, check: str, query: str, columns: str, message: str) -> str:
        keys = [f"{c if c in columns else 'NULL'} AS {c}" for c in ("profile_id", "specie_id", "aqm_poll")]
        value = next((c for c in ("percent", "sum_pct") if c in columns), "CAST(NULL AS DOUBLE)")
        return f"""SELECT 'crit' AS scenario_id, '{severity}' AS severity, '{check}' AS "check", {", ".join(keys)},
       {value} AS value, {message} AS message FROM ({sql[query]})"""

    sql["run_report"] = "\nUNION ALL\n".join(found(*f) for f in findings)

    # Several scenarios in one result.
    parts = {
        "crit": (_PLAIN, f"{_split_rows('crit', 'TOG')} UNION ALL {_VOC_ROWS.format(scenario='crit')}"),
        "flagless": (
            _gas("M_B", _PLAIN_TAIL, _PLAIN_WEIGHTS),
            _split_rows("flagless", "TOG", "aqm_poll NOT IN ('UNK', 'NONSOA')"),
        ),
        "nointegrate": (
            _gas("M_A", _NOINTEGRATE_TAIL, _NOINTEGRATE_WEIGHTS, _ACTOX),
            f"{_split_rows('nointegrate', 'TOG')} UNION ALL {_actox_rows('nointegrate', 'TOG')}",
        ),
        "ae6": (_pm("AE6"), _fraction_rows("ae6", "base_fractions")),
        "ae8": (_pm("AE8"), _fraction_rows("ae8", "base_fractions")),
    }
    sql["multi_scenario_splits"] = "\nUNION ALL\n".join(
        f"SELECT * FROM ({steps}\n{rows})" for steps, rows in parts.values()
    )
    return {name: text.strip() for name, text in sql.items()}
