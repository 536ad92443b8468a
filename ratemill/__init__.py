"""Rating analytics on Spark: decode, clean, model, report and recommend.

Every operator takes and returns DataFrames. Input and output live in
``ratemill.sources``, ``ratemill.streaming`` and ``ratemill.plans.cycle``.
"""
