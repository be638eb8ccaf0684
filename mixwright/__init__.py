"""Training-mix preparation on Spark.

Text corpora are packed into fixed-size token blocks, instruction pairs become
loss-masked examples, and both are merged into one ordered training set. Every
function takes and returns DataFrames (or Columns).
"""
