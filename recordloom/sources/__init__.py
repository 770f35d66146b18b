"""Where prompts come from."""
