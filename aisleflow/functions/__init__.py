"""Scalar functions as Column expressions; none of them needs a Python UDF."""
