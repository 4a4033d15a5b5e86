"""cohortloom: clinico-genomic cohort tables as Spark DataFrame jobs."""
