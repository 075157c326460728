"""DataFrame to DataFrame operators: cleaning, quality, revenue, retention."""
