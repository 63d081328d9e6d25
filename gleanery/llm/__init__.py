"""Operations of a training-data pipeline.

Nothing outside this folder imports it. Each module holds one operator; ``queries`` and
``contracts`` hold what the entry module registers.
"""
