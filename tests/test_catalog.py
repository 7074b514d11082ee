"""Measure requests, parameters and names."""

from ranklens.functions import catalog as C


def test_param_parsing_and_names():
    assert C.parse_measure("P.5,7,3").names() == ["P_3", "P_5", "P_7"]
    assert C.parse_measure("ndcg_cut.10,20,23.4").names() == ["ndcg_cut_10", "ndcg_cut_20", "ndcg_cut_23"]
    assert C.parse_measure("iprec_at_recall..10,.20").names() == ["iprec_at_recall_0.10", "iprec_at_recall_0.20"]
    assert C.parse_measure("utility.2,-1,0,0").names() == ["utility_2,-1,0,0"]
    assert C.parse_measure("ndcg.1=3,2=9,4=4.5").params == {1: 3.0, 2: 9.0, 4: 4.5}
    assert C.parse_measure("map").names() == ["map"]


def test_groups_expand_in_order():
    names = [m.name for m in C.expand("official")]
    assert names[:3] == ["runid", "num_q", "num_ret"] and names[-1] == "P"
    assert len(C.expand("all_trec")) == 34


def test_summary_kinds():
    assert C.summary_kind("num_ret") == C.SUM
    assert C.summary_kind("gm_map") == C.GEO
    assert C.summary_kind("P_10") == C.MEAN
    assert C.summary_kind("prefs_num_prefs_poss") == C.SUM


def _names(*requests):
    return [n for m in C.expand(list(requests)) for n in m.names()]


def test_given_parameters_replace_defaults():
    assert _names("P", "P.7") == ["P_7"] == _names("P.7", "P")
    assert [n for n in _names("official", "P.7") if n.startswith("P_")] == ["P_7"]
    assert _names("ndcg", "ndcg.1=3") == ["ndcg_1=3"]
    assert _names("map", "map") == ["map"]


def test_cutoffs_add_up_in_any_notation():
    assert _names(("P", [5]), ("P", [10])) == ["P_5", "P_10"]
    assert _names("P.10,5", ("P", [7]), "P.5") == ["P_5", "P_7", "P_10"]
    assert _names("iprec_at_recall..5", ("iprec_at_recall", [0.25])) == ["iprec_at_recall_0.25", "iprec_at_recall_0.50"]
    assert _names("recall.3", "map", "recall.4", "success.2") == ["recall_3", "recall_4", "map", "success_2"]


def test_other_parameter_sets_stay_apart():
    assert _names("utility.1,-1,0,0", "utility.2,-1,0,0", "utility.1,-1,0,0") == ["utility_1,-1,0,0", "utility_2,-1,0,0"]
    assert _names("set_F.2", "set_F.0.5", "set_F") == ["set_F_2", "set_F_0.5"]
    assert _names("relstring.5", "relstring.20") == ["relstring_5", "relstring_20"]
