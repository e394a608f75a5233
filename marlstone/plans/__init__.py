"""The jobs: bronze to silver to gold, each a function of DataFrames, and the lake they fill."""
