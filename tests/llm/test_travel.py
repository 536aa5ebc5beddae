from test_travel import run_elsewhere


def test_from_another_folder(small_sf, tmp_path):
    names = ["op10_packing", "op13_sentencepiece", "op12_importance", "op11_hard_negatives", "op7_minhash", "op2_quality"]
    run_elsewhere(tmp_path, small_sf, names)
