"""Batch job entry point (S8) for ``spark-submit``.

    spark-submit -m cohort.job --module identity --data s3a://bucket/prefix --out s3a://bucket/out
    python -m cohort.job --module identity --fixtures /root/testdata/sf0.1 --out /tmp/out   # local

``--data`` reads the engine's logical tables (``persons``, ``devices``,
``identity_signals``, ``events``, ``campaign_stream``) and brings them to their declared
contracts (string or whole-number ids); ``--fixtures`` builds the same shapes from the driver's test tables.
Outputs are Parquet tables plus a JSON-lines metrics table under ``--out``.
The master, memory and checkpoint directory come from the submit command.
"""
from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from cohort.operators import campaign
from cohort.plans import identity, metrics, models, segmentation
from cohort.session import ensure_checkpoint_dir, get_session
from cohort.sources.fixtures import Fixtures
from cohort.sources.sinks import write_metrics, write_table
from cohort.sources.tables import read_logical

MODULES = ("identity", "segmentation", "propensity", "ctr", "lookalike", "campaign")


def _inputs(spark, args):
    if args.fixtures:
        fx = Fixtures(spark, args.fixtures)
        return {"persons": fx.persons(), "devices": fx.devices(), "identity_signals": fx.signals(),
                "events": fx.events(), "campaign_stream": fx.campaign_stream()}
    return {n: read_logical(spark, args.data, n)
            for n in ("persons", "devices", "identity_signals", "events", "campaign_stream")}


def run(spark, module: str, t: dict, out: str) -> None:
    persons = t["persons"]
    g = identity.gate(persons, t["devices"], t["identity_signals"], t["events"])
    if module == "identity":
        r = identity.resolve_identities(persons, t["devices"], t["identity_signals"], t["events"])
        write_table(r.full_labels, f"{out}/resolved_ids")
        write_table(r.det_edges, f"{out}/deterministic_edges")
        write_table(r.prob_edges, f"{out}/probabilistic_edges")
        write_table(r.matcher.scored, f"{out}/matcher_scores")
        write_table(r.suppressed, f"{out}/suppressed_blocks")
        m = metrics.union_long([r.matcher.report, metrics.wide_to_long(identity.f1_lift(r.ablation)), r.counts()])
    elif module == "segmentation":
        s = segmentation.segment_people(g, persons)
        write_table(s.assignments, f"{out}/segments")
        m = metrics.union_long([s.silhouette.select(F.concat(F.lit("silhouette_k"), F.col("k").cast("string"))
                                                    .alias("metric"), F.col("silhouette").alias("value")),
                                s.ari.select(F.concat(F.lit("ari_"), "model").alias("metric"),
                                             F.col("ari").alias("value"))])
    elif module == "propensity":
        p = models.propensity_models(g, persons)
        write_table(p.scores, f"{out}/propensity_scores")
        m = p.report
    elif module == "ctr":
        c = models.ctr_model(g)
        write_table(c.scored, f"{out}/ctr_scores")
        m = c.report
    elif module == "lookalike":
        lk = models.als_lookalike(g, persons)
        write_table(lk.audience.where("selected"), f"{out}/audience")
        m = metrics.wide_to_long(lk.lift)
    elif module == "campaign":
        s = t["campaign_stream"].select(F.lit("default").alias("test"), F.col("creative").alias("arm"), "reward",
                                        "batch")
        post = campaign.beta_posterior(campaign.arm_counts(s))
        grid = campaign.grid_posterior(post)
        write_table(post.join(grid, ["test", "arm"]), f"{out}/posteriors")
        write_table(campaign.bandit_replay(s), f"{out}/replay")
        m = metrics.wide_to_long(campaign.winner(grid).drop("test", "winner"))
    else:
        raise ValueError(f"unknown module {module!r}; choose from {MODULES}")
    write_metrics(metrics.summary({module: m}), f"{out}/metrics")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--module", choices=MODULES, required=True)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--data")
    src.add_argument("--fixtures")
    ap.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    spark = get_session(f"cohort-{args.module}")
    ensure_checkpoint_dir(spark)
    run(spark, args.module, _inputs(spark, args), args.out.rstrip("/"))


if __name__ == "__main__":
    main()
