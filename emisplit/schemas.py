"""Table layouts: column order, types and integrity keys.

The layouts are fixed by the file formats (fixed values): column order follows
the headerless input files and the decimal scales decide how values round.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: Reference tables, loaded once.
SHARED = {
    "mechanism": "mechanism string, specie_id string, aqm_poll string, moles_per_mole decimal(20,12)",
    "pm_mechanism": "mechanism string, specie_id string, aqm_poll string, qualify boolean, compute boolean",
    "mechanism_description": (
        "mechanism string, description string, nonsoaflag string, origin string, reference string, comment string"
    ),
    "invtable": (
        "eminv_poll string, mode string, poll_code string, specie_id string, reactivity string, keep string, "
        "factor string, voc string, model string, explicit string, activity string, nti string, unit string, "
        "description string, cas_description string"
    ),
    "carbons": "mechanism string, aqm_poll string, num_carbons decimal(5,2)",
    "species": (
        "specie_id string, specie_name string, cas string, epaid string, saroad string, pams boolean, haps boolean, "
        "symbol string, molecular_weight decimal(20,12), non_voctog boolean, non_vol_wt string, unknown_wt string, "
        "unassign_wt string, exempt_wt string, volatile_mw decimal(20,12), num_carbons decimal(20,12), "
        "epa_itn string, comment string, vp_epi decimal(20,12), vp_um decimal(20,12)"
    ),
    "profiles": (
        "profile_id string, profile_name string, profile_type string, master_poll string, total decimal(10,5), "
        "norm_basis string, composite string, standard boolean, incl_gas boolean, test_year string, "
        "j_rating decimal(10,2), v_rating decimal(10,2), d_rating decimal(10,2), region string, samples string, "
        "lower_size decimal(10,4), upper_size decimal(10,4), sibling string, version string, "
        "voc_to_tog decimal(12,7), t_sample decimal(10,2), rh_sample decimal(10,2), p_loading decimal(10,2), "
        "o_loading decimal(10,2), gen_mechanism string, sec_equipment string, fuel_product string, "
        "ms_poll_rate decimal(10,2), ms_poll_unit string, om_to_oc decimal(10,2), mass_overage_pct decimal(15,12)"
    ),
    "profile_weights": (
        "profile_id string, specie_id string, percent decimal(12,6), uncertainty decimal(12,6), unc_method string, "
        "analytic_method string, include_in_sum string"
    ),
    "static": (
        "profile_id string, eminv_poll string, aqm_poll string, split_factor decimal(20,10), "
        "divisor decimal(20,10), mass_fraction decimal(20,10), aq_model string"
    ),
    "rename_species": "aq_model string, mechanism string, eminv_poll string, aqm_poll string",
    "o2m_ratios": "specie_id string, symbol string, o2m_ratio decimal(10,6)",
    "camx_fcrs": "profile_id string",
    "vbs_svoc_factors": (
        "profile_id string, cmaq_svocname string, camx_svocname string, bin0 decimal(10,6), bin1 decimal(10,6), "
        "bin2 decimal(10,6), bin3 decimal(10,6), bin4 decimal(10,6)"
    ),
    "vbs_ivoc_factors": (
        "profile_id string, cmaq_ivocname string, camx_ivocname string, nmogfraction decimal(10,6)"
    ),
    "ivoc_species": "aqm string, specie_id string, molwt decimal(10,6)",
    "metadata": "keyword string, dataval string, version string",
}

#: Per-scenario tables.
SCENARIO = {
    "toxics": "aqm_model string, specie_id string, aqm_poll string",
    "gas_process": "profile_id string, process string",
    "primary": "aqminv_poll string, aqm_add string, split_factor decimal(12,8), writeflag string",
    "user_profile_wts": "profile_id string, specie_id string, percent decimal(10,6)",
}

#: Columns whose combination must be unique.
KEYS = {
    "mechanism": ["mechanism", "specie_id", "aqm_poll"],
    "pm_mechanism": ["mechanism", "specie_id", "aqm_poll"],
    "mechanism_description": ["mechanism"],
    "carbons": ["mechanism", "aqm_poll"],
    "species": ["specie_id"],
    "profiles": ["profile_id"],
    "profile_weights": ["profile_id", "specie_id"],
    "static": ["profile_id", "eminv_poll", "aqm_poll", "aq_model"],
    "rename_species": ["aq_model", "mechanism", "eminv_poll", "aqm_poll"],
    "o2m_ratios": ["specie_id"],
    "camx_fcrs": ["profile_id"],
    "vbs_svoc_factors": ["profile_id"],
    "vbs_ivoc_factors": ["profile_id"],
    "ivoc_species": ["specie_id"],
    "metadata": ["keyword"],
    "toxics": ["aqm_model", "specie_id", "aqm_poll"],
    "gas_process": ["profile_id", "process"],
    "user_profile_wts": ["profile_id", "specie_id"],
    "gspro": ["scenario_id", "profile_id", "eminv_poll", "aqm_poll"],
}

#: Columns that may not be missing; empty text is allowed, NULL is not.
REQUIRED = {
    "invtable": ["eminv_poll", "specie_id"],
    "carbons": ["num_carbons"],
    "profile_weights": ["percent"],
    "o2m_ratios": ["o2m_ratio"],
    "vbs_ivoc_factors": ["nmogfraction"],
    "ivoc_species": ["molwt"],
    "primary": ["split_factor"],
    "user_profile_wts": ["percent"],
}

#: Fixed-width inventory layout: width of each of the 15 fields, in order.
INVTABLE_WIDTHS = (12, 4, 17, 6, 2, 2, 6, 2, 2, 2, 2, 4, 17, 41, 40)

#: Metadata keyword under which the source file of a table is recorded.
METADATA_KEYWORDS = {
    "invtable": "INVTABLE",
    "profile_weights": "PROFILES",
    "carbons": "CARBONS",
    "static": "STATIC",
    "camx_fcrs": "CAMX_FCRS",
    "vbs_svoc_factors": "VBS_SVOC_FACTORS",
    "vbs_ivoc_factors": "VBS_IVOC_FACTORS",
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SHARED.get(table) or SCENARIO[table])
