"""Incremental MAF merge over files landing in a folder."""

import os

from portalforge.streaming import start_maf_stream


def test_maf_stream_available_now(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    os.makedirs(src)
    for name, rows in (("a.maf", "TP53\tMissense_Mutation\tBS\n"), ("b.maf", "MYC\tSilent\tBS\nKRAS\tIGR\tBS\n"
                                                                    "TERT\t5'Flank\tBS\n")):
        with open(os.path.join(src, name), "w") as fh:
            fh.write("#version 2.4\nHugo_Symbol\tVariant_Classification\tTumor_Sample_Barcode\n" + rows)
    files = spark.createDataFrame([("P", "S1", "a.maf", None), ("P", "S2", "b.maf", "N")],
                                  "Cbio_project string, Cbio_Tumor_Name string, T_CL_BS_ID string, "
                                  "Cbio_Matched_Normal_Name string")
    out = os.path.join(tmpdir_fresh, "out")
    q = start_maf_stream(spark, src, files, ["Hugo_Symbol", "Variant_Classification", "Tumor_Sample_Barcode"],
                         out, checkpoint=os.path.join(tmpdir_fresh, "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = sorted((r.Hugo_Symbol, r.Tumor_Sample_Barcode) for r in spark.read.parquet(out).collect())
    assert got == [("TERT", "S2"), ("TP53", "S1")]
