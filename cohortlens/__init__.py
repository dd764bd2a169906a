"""cohortlens — cohort profiling, supervised feature building and
logistic-regression scoring on Spark DataFrames.

Every public function takes DataFrames plus plain parameters and returns
DataFrames. Functions that check a size, number rows or train a model run jobs
when called; nothing is collected to the driver except small, size-bounded
control values (counts, sizes, one sum).

Sub-packages
------------
sources    readers and writers (CSV events, driver tables, SVMLight text,
           model tables)
functions  column-expression helpers (dates, sigmoid, SVMLight tokens,
           deterministic hash split predicate)
operators  the relational operators: cohort tagging, index dates,
           observation window, metrics, top codes, features, dense index,
           split, learners, evaluation
plans      composite jobs chaining the operators (cohort profile, sample
           building) and the registry of checked queries
llm        operators of a training-data pipeline (optional; nothing else here
           imports it)
"""

__version__ = "0.1.0"
