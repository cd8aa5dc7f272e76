"""SQL expression texts shared by the models.

The models name their columns in SQL expressions: one text is one call into the JVM,
where the same expression built from Column objects is a dozen. Only column names and
constants of this package go into a text; parameters of a job or query never do.
"""
