"""Training-data operators: mixing, chat formatting, near-duplicate removal, token files,
sharding, language identification, licence scans, exact vector search, language-model
scoring, benchmark decontamination, line removal, collocations and conversation tries.

Nothing else in the library imports this subpackage. Every operator takes DataFrames and
returns DataFrames; intermediate tables go to the folder named in ``spark.checkpoint.dir``.
"""
