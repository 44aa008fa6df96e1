"""The registered queries, their inputs and their reference SQL."""
