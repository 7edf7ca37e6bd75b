"""Products: silver and gold tables, report sections and diagnoses, as functions of DataFrames."""
