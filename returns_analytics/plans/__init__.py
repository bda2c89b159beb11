"""The four computations as whole plans (pipelines) and as runs that store their results."""
