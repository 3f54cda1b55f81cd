"""talentlens — candidate ranking, sampling, training, audits and profiling as Spark jobs.

Entry points::

    from talentlens.plans.pipeline import rank_pipeline, score_candidates, rank_candidates
    from talentlens.plans.jobs import rank_job, label_job, train_job, qa_job, profile_job
"""

__version__ = "0.1.0"
