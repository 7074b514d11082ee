"""Measure catalogue: names, parameters, summary kinds, groups.

A measure request is a string ``name`` or ``name.params`` (``P.5,7,3``,
``utility.2,-1,0,0``, ``ndcg.1=3,2=9``) as the evaluation tool accepts, or a
``(name, params)`` tuple.  Parsing happens on the driver and only decides which
aggregate expressions are planned.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# fixed values: default parameters of the measures
CUTOFFS = (5, 10, 15, 20, 30, 100, 200, 500, 1000)
RECALL_POINTS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
RPREC_MULTS = (0.2, 0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0)
SUCCESS_CUTOFFS = (1, 5, 10)
UTILITY_COEFFS = (1.0, -1.0, 0.0, 0.0)
RELSTRING_LEN = 10
SET_F_BETA = 1.0
MIN_GEO_MEAN = 1e-5
INFAP_EPSILON = 1e-5
MISSING_ZSCORE = -1000000.0

# parameter kinds
INT_CUTS = "int_cuts"  # sorted, positive, unique longs; name_%d
FLOAT_CUTS = "float_cuts"  # sorted doubles; name_%3.2f
FLOAT_LIST = "float_list"  # kept in order; name_<raw> when given
GAIN_PAIRS = "gain_pairs"  # level=gain; name_<raw> when given
ONE_INT = "one_int"
ONE_FLOAT = "one_float"
NONE = "none"

# summary kinds
SUM, MEAN, GEO, COUNT, RUN, TOPIC_ONLY = "sum", "mean", "geo", "count", "run", "topic_only"

# fixed values: measure -> (parameter kind, default, summary kind)
SPEC: dict[str, tuple[str, object, str]] = {
    "runid": (NONE, None, RUN),
    "num_q": (NONE, None, COUNT),
    "num_ret": (NONE, None, SUM),
    "num_rel": (NONE, None, SUM),
    "num_rel_ret": (NONE, None, SUM),
    "map": (NONE, None, MEAN),
    "gm_map": (NONE, None, GEO),
    "Rprec": (NONE, None, MEAN),
    "bpref": (NONE, None, MEAN),
    "recip_rank": (NONE, None, MEAN),
    "iprec_at_recall": (FLOAT_CUTS, RECALL_POINTS, MEAN),
    "P": (INT_CUTS, CUTOFFS, MEAN),
    "relstring": (ONE_INT, RELSTRING_LEN, TOPIC_ONLY),
    "recall": (INT_CUTS, CUTOFFS, MEAN),
    "infAP": (NONE, None, MEAN),
    "gm_bpref": (NONE, None, GEO),
    "utility": (FLOAT_LIST, UTILITY_COEFFS, MEAN),
    "11pt_avg": (FLOAT_LIST, RECALL_POINTS, MEAN),
    "ndcg": (GAIN_PAIRS, {}, MEAN),
    "relative_P": (INT_CUTS, CUTOFFS, MEAN),
    "Rprec_mult": (FLOAT_CUTS, RPREC_MULTS, MEAN),
    "success": (INT_CUTS, SUCCESS_CUTOFFS, MEAN),
    "map_cut": (INT_CUTS, CUTOFFS, MEAN),
    "ndcg_cut": (INT_CUTS, CUTOFFS, MEAN),
    "ndcg_rel": (GAIN_PAIRS, {}, MEAN),
    "Rndcg": (GAIN_PAIRS, {}, MEAN),
    "binG": (NONE, None, MEAN),
    "G": (GAIN_PAIRS, {}, MEAN),
    "set_P": (NONE, None, MEAN),
    "set_recall": (NONE, None, MEAN),
    "set_relative_P": (NONE, None, MEAN),
    "set_map": (NONE, None, MEAN),
    "set_F": (ONE_FLOAT, SET_F_BETA, MEAN),
    "num_nonrel_judged_ret": (NONE, None, SUM),
    # judgment groups
    "map_avgjg": (NONE, None, MEAN),
    "P_avgjg": (INT_CUTS, CUTOFFS, MEAN),
    "Rprec_mult_avgjg": (FLOAT_CUTS, RPREC_MULTS, MEAN),
    # preferences
    "prefs_num_prefs_poss": (NONE, None, SUM),
    "prefs_num_prefs_ful": (NONE, None, SUM),
    "prefs_num_prefs_ful_ret": (NONE, None, SUM),
    "prefs_simp": (NONE, None, MEAN),
    "prefs_pair": (NONE, None, MEAN),
    "prefs_avgjg": (NONE, None, MEAN),
    "prefs_avgjg_Rnonrel": (NONE, None, MEAN),
    "prefs_simp_ret": (NONE, None, MEAN),
    "prefs_pair_ret": (NONE, None, MEAN),
    "prefs_avgjg_ret": (NONE, None, MEAN),
    "prefs_avgjg_Rnonrel_ret": (NONE, None, MEAN),
    "prefs_simp_imp": (NONE, None, MEAN),
    "prefs_pair_imp": (NONE, None, MEAN),
    "prefs_avgjg_imp": (NONE, None, MEAN),
}

# fixed values: named measure groups
GROUPS: dict[str, tuple[str, ...]] = {
    "official": ("runid", "num_q", "num_ret", "num_rel", "num_rel_ret", "map", "gm_map",
                 "Rprec", "bpref", "recip_rank", "iprec_at_recall", "P"),
    "set": ("runid", "num_q", "num_ret", "num_rel", "num_rel_ret", "utility", "set_P",
            "set_recall", "set_relative_P", "set_map", "set_F"),
    "all_trec": ("runid", "num_q", "num_ret", "num_rel", "num_rel_ret", "map", "gm_map",
                 "Rprec", "bpref", "recip_rank", "iprec_at_recall", "P", "relstring",
                 "recall", "infAP", "gm_bpref",
                 "utility", "11pt_avg", "ndcg", "relative_P", "Rprec_mult", "success",
                 "map_cut", "ndcg_cut", "ndcg_rel", "Rndcg", "binG", "G",
                 "set_P", "set_recall", "set_relative_P", "set_map", "set_F",
                 "num_nonrel_judged_ret"),
    "all_prefs": ("runid", "num_q", "prefs_num_prefs_poss", "prefs_num_prefs_ful",
                  "prefs_num_prefs_ful_ret",
                  "prefs_simp", "prefs_pair", "prefs_avgjg", "prefs_avgjg_Rnonrel",
                  "prefs_simp_ret", "prefs_pair_ret", "prefs_avgjg_ret",
                  "prefs_avgjg_Rnonrel_ret",
                  "prefs_simp_imp", "prefs_pair_imp", "prefs_avgjg_imp"),
    "prefs": ("runid", "num_q",
              "prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret",
              "prefs_simp", "prefs_pair", "prefs_avgjg"),
    "qrels_jg": ("runid", "num_q", "map_avgjg", "P_avgjg", "Rprec_mult_avgjg"),
}

PREF_MEASURES = tuple(m for m in SPEC if m.startswith("prefs_"))
JG_MEASURES = ("map_avgjg", "P_avgjg", "Rprec_mult_avgjg")


@dataclass(frozen=True)
class Measure:
    """One requested measure with its parsed parameters."""

    name: str
    params: object = None
    raw: str | None = None  # parameter text as given, None for defaults
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def kind(self) -> str:
        return SPEC[self.name][2]

    def names(self) -> list[str]:
        """Output names, one per value (``P_5`` …)."""
        pk = SPEC[self.name][0]
        if pk == INT_CUTS:
            return [f"{self.name}_{int(k)}" for k in self.params]
        if pk == FLOAT_CUTS:
            return [f"{self.name}_{c:3.2f}" for c in self.params]
        if pk in (FLOAT_LIST, GAIN_PAIRS, ONE_FLOAT, ONE_INT) and self.raw is not None:
            return [f"{self.name}_{self.raw}"]
        return [self.name]


def _parse_params(name: str, raw: str):
    pk = SPEC[name][0]
    if pk == INT_CUTS:
        vals = sorted({int(float(x)) for x in raw.split(",") if x.strip()})
        if not vals or vals[0] <= 0:
            raise ValueError(f"{name}: cutoffs must be positive integers: {raw!r}")
        return tuple(vals)
    if pk == FLOAT_CUTS:
        vals = sorted({float(x) for x in raw.split(",") if x.strip()})
        return tuple(vals)
    if pk == FLOAT_LIST:
        return tuple(float(x) for x in raw.split(",") if x.strip())
    if pk == GAIN_PAIRS:
        out = {}
        for item in raw.split(","):
            lv, g = item.split("=")
            out[int(lv)] = float(g)
        return out
    if pk == ONE_INT:
        return int(float(raw))
    if pk == ONE_FLOAT:
        return float(raw)
    raise ValueError(f"{name} takes no parameters")


def parse_measure(req) -> Measure:
    """``'P.5,10'`` / ``('P', [5, 10])`` / ``'map'`` -> :class:`Measure`."""
    if isinstance(req, Measure):
        return req
    if isinstance(req, tuple):
        name, params = req
        if name not in SPEC:
            raise ValueError(f"unknown measure {name!r}")
        if isinstance(params, str):
            return Measure(name, _parse_params(name, params), params)
        pk = SPEC[name][0]
        if pk in (INT_CUTS, FLOAT_CUTS):
            params = tuple(sorted(set(params)))
        raw = None
        if pk == GAIN_PAIRS:
            params = dict(params)
            raw = ",".join(f"{k}={v:g}" for k, v in params.items())
        elif pk == FLOAT_LIST:
            params = tuple(params)
            raw = ",".join(f"{v:g}" for v in params)
        return Measure(name, params, raw)
    name, _, raw = str(req).partition(".")
    if name not in SPEC:
        raise ValueError(f"unknown measure {name!r}")
    if raw:
        return Measure(name, _parse_params(name, raw), raw)
    return Measure(name, SPEC[name][1], None)


def expand(requests) -> list[Measure]:
    """Group names, parsed measures, first occurrence order.

    Given parameters replace a measure's defaults, wherever it was named
    before or is named again.  Cutoffs that are given several times, in any
    notation, add up; other parameter sets stay apart, each a measure of its
    own.  A repeated request is one.
    """
    if requests is None:
        requests = ["official"]
    if isinstance(requests, (str, tuple, Measure)):
        requests = [requests]
    given: dict[str, list[Measure]] = {}
    for req in requests:
        for m in [parse_measure(n) for n in GROUPS[req]] if isinstance(req, str) and req in GROUPS else [parse_measure(req)]:
            held = given.setdefault(m.name, [])
            own = [x for x in held if not _default(x)]
            if _default(m):
                given[m.name] = own or [m]
            elif SPEC[m.name][0] in (INT_CUTS, FLOAT_CUTS):
                cuts = sorted({c for x in (*own, m) for c in x.params})
                given[m.name] = [Measure(m.name, tuple(cuts), ",".join(f"{c:g}" for c in cuts))]
            else:
                given[m.name] = own if m in own else [*own, m]
    return [m for held in given.values() for m in held]


def _default(m: Measure) -> bool:
    return m.raw is None and m.params == SPEC[m.name][1]


def summary_kind(measure_name: str) -> str:
    """Summary kind of an output name such as ``P_5`` or ``ndcg_1=3``."""
    if measure_name in SPEC:
        return SPEC[measure_name][2]
    for base in sorted(SPEC, key=len, reverse=True):
        if measure_name.startswith(base + "_"):
            return SPEC[base][2]
    return MEAN
