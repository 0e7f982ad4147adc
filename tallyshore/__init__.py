"""Customer analytics on Spark: churn labels and features, feedback texts,
models, and a conformed star schema. Every public function takes DataFrames
and returns a lazy DataFrame unless its docstring says it runs a job."""
