"""dialoom: relational processing of assistant-conversation archives on Spark."""
