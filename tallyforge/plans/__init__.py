"""Plan shapes shared by operators: durable tables, ordered sums within hot keys."""
