"""Model backends: the contract and a stand-in."""
