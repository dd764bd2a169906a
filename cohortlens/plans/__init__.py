"""Composite jobs and the registry of checked queries."""

from cohortlens.plans.cohort_profile import cohort_profile
from cohortlens.plans.sample_build import build_samples

__all__ = ["cohort_profile", "build_samples"]
